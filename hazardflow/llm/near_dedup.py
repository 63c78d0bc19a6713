"""Near-duplicate classes by BagMinHash signatures, banding, and verified multiset overlap.

A document is the bag of its five-word runs; two documents are linked if the weighted Jaccard similarity
of their bags (sum of least over sum of greatest multiplicities) is at least ``threshold``; classes are
the connected components of the links.

* Signatures (``BagMinHash``): every shingle owns a Poisson process over (time, component, weight level).
  Weight levels are discretised to integers and cut into strips (0,1], (1,2], (2,4], (4,8] .. with a process
  of their own each, whose rate is the strip's length; a shingle of multiplicity w uses the strips below w
  and thins the one that holds w. Points come in ascending time, so a strip is left at the first point
  behind the document's time horizon: a long document costs little more than one draw a shingle. The
  earliest point of each component is the signature; two agree there with the probability of the
  weighted Jaccard similarity.
* Exact copies (equal word sequences) are one node from here on.
* Banding: ``BANDS`` bands of ``ROWS`` components; at similarity 0.8 a pair shares no band with
  probability (1 - 0.8^5)^30 < 7e-6.
* Verification: in every bucket the member that shares the largest buckets (usually the text the others
  were copied from) is compared with all the others, so a group costs one comparison a member, not all
  pairs. Where members of a bucket are in different components afterwards, pairs across components are
  compared too, so no link between classes is lost: in small buckets those pairs whose signatures agree
  well enough, in large ones all members outside the largest component with all members, in chunks of
  texts whose overlaps are one matrix product and that pass on only links which join components.

Defined results: null and wordless texts are equal (one class); texts of one to four words are one
shingle; repeated rows are copies of each other; null ids sort first; an empty table has no classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package
from .batches import Words, mix, shingle_hashes, slices
from .columns import text_of
from .components import components

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 30, 5
M = BANDS * ROWS
#: A pair at the threshold has fewer equal signature components than this share with probability < 1e-6.
AGREEMENT = 0.62
#: Buckets of up to SMALL members are compared pair by pair, larger ones in chunks of texts.
SMALL, CHUNK = 64, 512
#: Drawn points (about 1,400 a text) that are held before they are put into the signatures.
POINTS = 1 << 17
#: Nodes whose texts are looked up by a broadcast of keys (16 bytes each); beyond, by a shuffle of the texts.
BROADCAST_KEYS = 2_000_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ELEMENT_BITS = np.uint64(44)


def _times(n: int) -> np.uint64:
    return np.uint64(n * int(_STEP) & 0xFFFFFFFFFFFFFFFF)


def _unit(x: np.ndarray) -> np.ndarray:
    """(0, 1] from 64 random bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def bag_minhash(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, m: int = M) -> np.ndarray:
    """Signatures (n_docs x m, uint64; 0 for documents without elements) of integer-weighted bags."""
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    first = np.full((n_docs, m), np.inf)
    value = np.zeros((n_docs, m), np.uint64)
    wanted = total > 0
    reach = np.log(m) + 4.0  # about one document in fifty needs a second look
    while wanted.any():
        rows = wanted[doc]
        horizon = np.divide(reach, total, out=np.zeros_like(total), where=total > 0)
        _fill(first, value, doc[rows], element[rows], weight[rows], horizon, m)
        wanted = wanted & np.isinf(first).any(axis=1)  # a component had no point yet: look further ahead
        reach *= 2.0
    return value


def _fill(first, value, doc, element, weight, horizon, m) -> None:
    cells, times, marks = [], [], []

    def put() -> None:
        """The points gathered so far; the earliest of a component over all calls stays."""
        if cells:
            cell, time, mark = np.concatenate(cells), np.concatenate(times), np.concatenate(marks)
            np.minimum.at(first.reshape(-1), cell, time)
            won = time == first.reshape(-1)[cell]
            value.reshape(-1)[cell[won]] = mark[won]
            for held in (cells, times, marks):
                held.clear()

    low, strip = 0, 0
    while len(doc):
        high = 1 << strip
        _strip_points(doc, element, weight, low, high, strip, horizon, m, cells, times, marks, put)
        more = weight > high
        doc, element, weight = doc[more], element[more], weight[more]
        low, strip = high, strip + 1
    put()


def _strip_points(doc, element, weight, low, high, strip, horizon, m, cells, times, marks, put) -> None:
    seed = mix(element + _times(strip + 1))
    rate = float(m * (high - low))
    until, at, nth, held = horizon[doc], np.zeros(len(doc)), 0, 0
    while len(doc):
        nth += 1
        bits = mix(seed + _times(nth))
        at = at - np.log(_unit(bits)) / rate
        live = at <= until
        doc, seed, weight, until, at, bits = doc[live], seed[live], weight[live], until[live], at[live], bits[live]
        draw = mix(bits + np.uint64(1))
        component = ((draw >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        level = low + (high - low) * ((draw & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32)
        used = level < weight
        cells.append(doc[used] * m + component[used])
        times.append(at[used])
        marks.append(bits[used])
        held += len(marks[-1])
        if held > POINTS:
            put()
            held = 0


def _bags(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    doc, h = shingle_hashes(words, n)
    key = np.sort((doc.astype(np.uint64) << _ELEMENT_BITS) | (h >> (np.uint64(64) - _ELEMENT_BITS)))
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    weight = np.diff(np.append(at, len(key)))
    key = key[at]
    return (key >> _ELEMENT_BITS).astype(np.int64), key & ((np.uint64(1) << _ELEMENT_BITS) - np.uint64(1)), weight


def _sequence_hash(words: Words) -> np.ndarray:
    """64-bit fingerprint of each text's word sequence."""
    place = np.arange(len(words.hashes)) - np.repeat(words.first[:-1], words.counts)
    term = mix(words.hashes ^ mix(place.astype(np.uint64) + _STEP))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(term, dtype=np.uint64)])
    return mix(sums[words.first[1:]] - sums[words.first[:-1]] + words.counts.astype(np.uint64) * _STEP)


def _band_keys(signature: np.ndarray) -> np.ndarray:
    rows = signature.reshape(len(signature), BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP, rows.shape[:2]).copy()
    for k in range(ROWS):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + rows[:, :, k])
    return out


def _print_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(2)
        for lo, hi in slices(texts):
            w = Words(texts.slice(lo, hi - lo))
            n = hi - lo
            signature = bag_minhash(*_bags(w, SHINGLE), n)
            keys = _band_keys(signature).view(np.int64)
            has = w.counts > 0
            per = np.where(has, BANDS, 0)
            bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32()),
                                             pa.array(keys[has].reshape(-1), pa.int64()))
            short = (signature & np.uint64(0xFF)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, n), batch.column(1).slice(lo, n), pa.array(_sequence_hash(w).view(np.int64)),
                 bands, pa.array([row.tobytes() for row in short], pa.binary())],
                names=["_id", "_h", "node", "bands", "sig"])


def fingerprints(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(_id, _h, node, bands, sig): text hash, word-sequence fingerprint, band keys, one byte a component."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(key).alias("_id"), F.xxhash64(text_of(F.col(text))).alias("_h"), text_of(F.col(text)).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(_print_batches, f"_id {id_type}, _h long, node long, bands array<long>, sig binary")


def bag_similarity(a: pa.Array, b: pa.Array, n: int = SHINGLE) -> np.ndarray:
    """Weighted Jaccard similarity of the shingle bags of ``a[i]`` and ``b[i]``; two empty bags are equal."""
    (da, ha), (db, hb) = shingle_hashes(Words(a), n), shingle_hashes(Words(b), n)
    doc, h = np.concatenate([da, db]), np.concatenate([ha, hb])
    side = np.concatenate([np.ones(len(da), np.int64), np.zeros(len(db), np.int64)])
    if not len(doc):
        return np.ones(len(a))
    order = np.lexsort((h, doc))
    doc, h, side = doc[order], h[order], side[order]
    at = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]))
    in_a, in_b = np.add.reduceat(side, at), np.add.reduceat(1 - side, at)
    least = np.bincount(doc[at], weights=np.minimum(in_a, in_b), minlength=len(a))
    most = np.bincount(doc[at], weights=np.maximum(in_a, in_b), minlength=len(a))
    return np.where(most > 0, least / np.maximum(most, 1), 1.0)


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(2), 1 << 19):
                part = batch.slice(lo, hi - lo)
                alike = bag_similarity(part.column(2), part.column(3)) >= threshold
                yield part.select([0, 1]).filter(pa.array(alike))
    return run


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Pairs (u, v) whose texts (node, _text) are similar enough, checkpointed."""
    side = lambda name, c: texts.select(F.col("node").alias(name), F.col("_text").alias(c))
    rows = pairs.join(side("u", "_a"), "u").join(side("v", "_b"), "v").select("u", "v", "_a", "_b")
    return cut_lineage(rows.mapInArrow(_verify(threshold), "u long, v long"))


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (u, v, sa, sb) whose signatures agree in a share of ``AGREEMENT`` components or more."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(-1, M) for c in batch.columns[2:])
        yield batch.select([0, 1]).filter(pa.array((a == b).mean(axis=1) >= AGREEMENT))


def _tokens(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, token): one token per shingle and occurrence, so that shared tokens count a multiset overlap."""
    doc, h = shingle_hashes(Words(texts), n)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    fresh = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]) if len(h) else np.zeros(0, bool)
    at = np.arange(len(h))
    occurrence = at - np.maximum.accumulate(np.where(fresh, at, 0)) if len(h) else at
    return doc, mix(h + occurrence.astype(np.uint64) * _STEP)


def overlap_matrix(a: pa.Array, b: pa.Array, n: int = SHINGLE, tile: int = 8192) -> np.ndarray:
    """Weighted Jaccard similarity of every text of ``a`` with every text of ``b``, by products of 0/1 matrices."""
    (da, ta), (db, tb) = _tokens(a, n), _tokens(b, n)
    size_a, size_b = np.bincount(da, minlength=len(a)), np.bincount(db, minlength=len(b))
    shared = np.intersect1d(ta, tb)
    common = np.zeros((len(a), len(b)), np.float32)
    for begin in range(0, len(shared), tile):
        part = shared[begin: begin + tile]

        def marks(doc, token, rows):
            at = np.minimum(np.searchsorted(part, token), len(part) - 1)
            hit = part[at] == token
            out = np.zeros((rows, len(part)), np.float32)
            out[doc[hit], at[hit]] = 1.0
            return out

        common += marks(da, ta, len(a)) @ marks(db, tb, len(b)).T
    union = size_a[:, None] + size_b[None, :] - common
    return np.where(union > 0, common / np.maximum(union, 1), 1.0)


def _link_chunks(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        a, b = group.filter(group.column("rest")), group.filter(pc.invert(group.column("rest")))
        (ua, la), (ub, lb) = ((t.column("node").to_numpy(), t.column("label").to_numpy()) for t in (a, b))
        out: list[tuple[int, int]] = []
        if len(ua) and len(ub):
            alike = overlap_matrix(a.column("_text").combine_chunks(), b.column("_text").combine_chunks()) >= threshold
            parent: dict[int, int] = {}

            def root(x: int) -> int:
                while parent.setdefault(x, x) != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for i, j in zip(*(x.tolist() for x in np.nonzero(alike & (la[:, None] != lb[None, :])))):
                p, q = root(int(la[i])), root(int(lb[j]))
                if p != q:  # only links that join components that aren't joined yet
                    parent[p] = q
                    out.append((int(ua[i]), int(ub[j])))
        return pa.table({"u": pa.array([x[0] for x in out], pa.int64()), "v": pa.array([x[1] for x in out], pa.int64())})
    return run


def links_in_large(large: DataFrame, texts: DataFrame, threshold: float, chunk: int) -> DataFrame:
    """Links (u, v) between components in buckets ``large`` (bkey, node, label), enough to join all that are linked.

    Members outside a bucket's most frequent component are compared with all members, chunk by chunk: a group
    of ``chunk`` x ``chunk`` texts is one matrix product, and its result at most as many links as members.
    """
    by_label = large.groupBy("bkey", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = by_label.groupBy("bkey").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("size"))
    sizes = sizes.select("bkey", F.col("top.label").alias("top"), F.ceil(F.col("size") / chunk).cast("int").alias("nb"),
                         F.ceil((F.col("size") - F.col("top.n")) / chunk).cast("int").alias("na"))
    rows = large.join(sizes, "bkey")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    rest = rows.where("label <> top").select("bkey", "node", "label", F.lit(True).alias("rest"),
                                             F.pmod(F.xxhash64("node"), F.col("na")).cast("int").alias("ca"), every("nb").alias("cb"))
    all_ = rows.select("bkey", "node", "label", F.lit(False).alias("rest"), every("na").alias("ca"),
                       F.pmod(F.xxhash64("node", F.lit("b")), F.col("nb")).cast("int").alias("cb"))
    dealt = rest.unionByName(all_).join(texts, "node")
    return dealt.groupBy("bkey", "ca", "cb").applyInArrow(_link_chunks(threshold), "u long, v long")


def near_duplicate_classes(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                           threshold: float = THRESHOLD) -> DataFrame:
    """(_id, _h, node, class_id, is_kept, k) per row; the class id is the least id of the class, which is kept."""
    prints = cut_lineage(fingerprints(docs, key, text))
    who = F.min(F.struct("_id", "_h"))
    nodes = cut_lineage(prints.groupBy("node").agg(who.alias("who"), F.any_value("bands").alias("bands"),
                                                   F.any_value("sig").alias("sig")))
    rows = nodes.select("node", F.explode("bands").alias("bkey"))
    shared = rows.groupBy("bkey").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = cut_lineage(rows.join(shared, "bkey"))
    central = members.groupBy("node").agg(F.sum("size").alias("central"), F.collect_list("bkey").alias("bkeys"))  # BANDS keys or fewer
    ranked = central.select("node", "central", F.explode("bkeys").alias("bkey"))
    pivots = ranked.groupBy("bkey").agg(F.max(F.struct("central", "node")).getField("node").alias("u"))
    pairs = cut_lineage(members.join(pivots, "bkey").where("node <> u").select("u", F.col("node").alias("v")).distinct())

    packed = docs.select(F.xxhash64(F.col(key), F.xxhash64(text_of(F.col(text)))).alias("k"), text_of(F.col(text)).alias("_text"))

    def texts_of(wanted: DataFrame) -> DataFrame:
        asked = cut_lineage(nodes.join(wanted.distinct(), "node").select("node", F.xxhash64("who._id", "who._h").alias("k")))
        asked = F.broadcast(asked) if asked.count() <= BROADCAST_KEYS else asked
        found = asked.join(packed, "k").groupBy("node").agg(F.any_value("_text").alias("_text"))
        return cut_lineage(found)

    members_of = lambda p: p.select(F.col("u").alias("node")).unionByName(p.select(F.col("v").alias("node")))
    links = verified(pairs, texts_of(members_of(pairs)), threshold)
    # a first label: the least pivot that a node is linked to, else the node itself; equal labels are one component
    labels = links.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("label"))
    labelled = members.select("bkey", "node").join(labels, "node", "left").select(
        "bkey", "node", F.coalesce("label", "node").alias("label"))
    open_keys = labelled.groupBy("bkey").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("bkey")
    open_rows = labelled.join(open_keys, "bkey")
    left = cut_lineage(open_rows.join(open_rows.groupBy("bkey").agg(F.count(F.lit(1)).alias("size")), "bkey"))
    small = left.where(F.col("size") <= SMALL)
    a = small.select("bkey", F.col("node").alias("u"), F.col("label").alias("la"))
    b = small.select("bkey", F.col("node").alias("v"), F.col("label").alias("lb"))
    across = a.join(b, "bkey").where("la < lb").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    across = across.join(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")), ["u", "v"], "left_anti")
    signed = lambda name, c: nodes.select(F.col("node").alias(name), F.col("sig").alias(c))
    rest = cut_lineage(across.join(signed("u", "sa"), "u").join(signed("v", "sb"), "v").select(
        "u", "v", "sa", "sb").mapInArrow(_agreeing, "u long, v long"))
    large = left.where(F.col("size") > SMALL).select("bkey", "node", "label")
    texts = texts_of(members_of(rest).unionByName(large.select("node")))
    more = verified(rest, texts, threshold)
    if not large.isEmpty():
        more = more.unionByName(links_in_large(large, texts, threshold, CHUNK))
    labels = components(links.unionByName(more))
    placed = nodes.select("node", "who").join(labels, "node", "left").select(
        "node", "who", F.coalesce("label", "node").alias("label"))
    classes = placed.groupBy("label").agg(F.min("who").alias("kept"))
    by_node = placed.join(classes, "label").select("node", "kept")
    out = prints.select("_id", "_h", "node").join(by_node, "node")
    return out.select("_id", "_h", "node", F.col("kept._id").alias("class_id"),
                      F.struct("_id", "_h").eqNullSafe(F.col("kept")).alias("is_kept"), F.xxhash64("_id", "_h").alias("k"))


def drop_near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class: the least id, of repeated rows any one."""
    keep = near_duplicate_classes(docs, key=key, text=text, threshold=threshold).where("is_kept").select("k").distinct()
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                         F.xxhash64(F.col(key), F.xxhash64(text_of(F.col(text)))).alias("k"))
    return packed.join(keep, "k", "left_semi").groupBy("k").agg(F.any_value("_row").alias("_row")).select("_row.*")


def op2_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicate_classes(docs).select(F.col("_id").alias("doc_id"), "class_id", "is_kept")
