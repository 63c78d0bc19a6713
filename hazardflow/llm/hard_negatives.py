"""Hard-negative mining: a secondary sort of (anchor, descending score, id) keys, read by a streaming iterator.

For every anchor row: its positives are the first rows of the same label by (score, id), and for each
positive the first rows of other labels whose score lies between two shares of the positive's score. Scores
are integer inner products of scaled components, so ties and windows are exact.

How it works. Rows and anchors meet in cells of at most ``ANCHORS`` anchors and about ``CHUNK`` rows, where
numpy forms the scores; no cell emits its pairs. The first pass emits each anchor's best rows of its label
in the cell, whose global order gives the positives. The second pass knows the positives' windows and emits
what can still be among the first of a window: at most ``negatives`` rows an anchor, window and cell. Only
these keys are shuffled, by ``repartitionAndSortWithinPartitions``: an iterator over the sorted keys meets an
anchor's positives before the negatives of their windows, opens a window at each, and emits negatives until
the window is full. It holds the open windows of one anchor, never an anchor's rows. Dropping a row in a cell
never changes a result, as that cell alone holds enough rows that come before it.

At scale: every task holds one cell (a few MB) or a stream. Rows are dealt to chunks by their number in the
written table, so repeated ids, hot labels and equal vectors spread evenly. Work is anchors x rows by the
task's nature; rows are copied once a block of anchors, anchors once a chunk of rows. The written table in
the folder of ``spark.checkpoint.dir`` is what lost tasks are repeated from.

Defined results: rows with a null label, a null vector or a null or non-finite component take no part;
an empty vector has the score 0 with every row; of vectors of unequal length the shorter counts as followed by
zeros. A row is no positive of an anchor with the same id, repeated rows are rows of their own otherwise
(an anchor that stands twice is mined twice). Null ids are no anchors and come last in ties. Scaled components
and scores beyond 64 bits saturate. A positive of a negative score has an empty window. Extra columns play no
role; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import written

CHUNK = 2_048
ANCHORS = 4_096
MOST = (1 << 63) - 1

SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_KEYS = "no long, anchor_id long, score long, kind int, id long"


def finite_vectors(col: Column) -> Column:
    """True for a vector without null or non-finite components."""
    def fine(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return col.isNotNull() & F.coalesce(F.forall(col.cast("array<double>"), fine), F.lit(False))


# ---------------------------------------------------------------- cells (numpy)

def matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Rows of integer components, shorter ones followed by zeros."""
    flat = vectors.combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    offsets = flat.offsets.to_numpy()
    sizes = np.diff(offsets)
    out = np.zeros((len(flat), int(sizes.max(initial=0))), np.int64)
    values = flat.values.to_numpy(zero_copy_only=False)[offsets[0]: offsets[-1]] if len(flat) else np.zeros(0, np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = values
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` and ``b``: in double precision where sums stay below 2**53."""
    d = min(a.shape[1], b.shape[1])
    a, b = a[:, :d], b[:, :d]
    widest = [max(abs(int(m.min(initial=0))), int(m.max(initial=0))) for m in (a, b)]
    if d * widest[0] * widest[1] < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -MOST, MOST).astype(np.int64)


def window_of(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest integer s with ``low * score <= 100 * s <= high * score``."""
    return -(-low * score // 100), high * score // 100


def _cell(anchors: pa.Table, rows: pa.Table) -> Iterator[tuple]:
    """For each anchor of a cell: its index, rows in the order (descending score, id), their scores, labels and ids."""
    if not len(anchors) or not len(rows):
        return
    rows = rows.sort_by([("id", "ascending")])  # nulls last; later sorts are stable
    table, labels = matrix(rows["v"]), rows["label"].to_numpy()
    ids = rows["id"].to_pylist()
    known = np.array([x is not None for x in ids])
    numbers = np.array([x or 0 for x in ids], np.int64)
    for begin in range(0, len(anchors), 256):
        some = anchors.slice(begin, 256)
        for i, s in enumerate(scores(matrix(some["a_v"]), table)):
            order = np.argsort(-s, kind="stable")
            yield begin + i, s[order], labels[order], numbers[order], known[order]


def _keys(found: list[tuple[pa.Table, int, np.ndarray, np.ndarray, np.ndarray]], kind: int) -> pa.Table:
    """Key rows of (anchor, its scores, ids, ids known) lists."""
    sizes = [len(f[1]) for f in found]
    cat = lambda k, t: np.concatenate([f[k] for f in found]) if found else np.zeros(0, t)
    no = np.repeat(np.array([f[0][0] for f in found], np.int64), sizes)
    anchor = np.repeat(np.array([f[0][1] for f in found], np.int64), sizes)
    return pa.table({"no": no, "anchor_id": anchor, "score": cat(1, np.int64),
                     "kind": np.full(len(no), kind, np.int32),
                     "id": pa.array(cat(2, np.int64), mask=~cat(3, bool))})


def _best_positives(k: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        no, own, label = anchors["a_no"].to_numpy(), anchors["a_id"].to_numpy(), anchors["a_label"].to_numpy()
        found = []
        for i, s, labels, ids, known in _cell(anchors, rows):
            at = np.flatnonzero((labels == label[i]) & ~(known & (ids == own[i])))[:k]
            found.append(((no[i], own[i]), s[at], ids[at], known[at]))
        return _keys(found, 0)
    return run


def _best_negatives(k: int, low: int, high: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        no, own, label = anchors["a_no"].to_numpy(), anchors["a_id"].to_numpy(), anchors["a_label"].to_numpy()
        opened = anchors["a_scores"].to_pylist()
        found = []
        for i, s, labels, ids, known in _cell(anchors, rows):
            other, falling, take = labels != label[i], -s, []
            for positive in set(opened[i]):
                least, most = window_of(positive, low, high)
                begin, end = np.searchsorted(falling, [-most, -least + 1]) if least <= most else (0, 0)
                take.append(begin + np.flatnonzero(other[begin:end])[:k])
            at = np.unique(np.concatenate(take)) if take else np.zeros(0, np.int64)
            found.append(((no[i], own[i]), s[at], ids[at], known[at]))
        return _keys(found, 1)
    return run


# ---------------------------------------------------------------- the sorted stream

def sort_key(no: int, score: int, kind: int, row_id: int | None) -> tuple:
    """Anchor, falling score, positives before negatives of the same score, id (nulls last)."""
    return no, -score, kind, row_id is None, row_id or 0


def emit(keys: Iterable[tuple[tuple, int]], positives: int, negatives: int, low: int, high: int) -> Iterator[tuple]:
    """Result rows from (key, anchor id) in key order; holds the open windows of one anchor only."""
    current, open_windows, met = None, [], 0
    for (no, falling, kind, no_id, number), anchor_id in keys:
        if no != current:
            current, open_windows, met = no, [], 0
        score, row_id = -falling, None if no_id else number
        if kind == 0:
            met += 1
            if met <= positives:
                open_windows.append([row_id, score, *window_of(score, low, high), 0])
            continue
        for w in open_windows:
            if w[4] < negatives and w[2] <= score <= w[3]:
                w[4] += 1
                yield anchor_id, w[0], w[4], row_id, w[1], score


# ---------------------------------------------------------------- Spark

def mine_hard_negatives(rows: DataFrame, anchor: Column, *, key: str = "vec_id", label: str = "label",
                        vector: str = "embedding", scale: int = 256, positives: int = 5, negatives: int = 10,
                        low: int = 30, high: int = 90) -> DataFrame:
    """``SCHEMA`` rows: per anchor row (where ``anchor`` holds) and positive the first ``negatives`` of its window.

    The window of a positive of score p holds scores s with ``low * p <= 100 * s <= high * p``.
    """
    spark = rows.sparkSession
    scaled = F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(F.lit(float(scale)) * x))
    table = written(rows.where(F.col(label).isNotNull() & finite_vectors(F.col(vector))).select(
        F.monotonically_increasing_id().alias("no"), F.col(key).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"), scaled.alias("v"),
        (F.coalesce(anchor, F.lit(False)) & F.col(key).isNotNull()).alias("asks")), "hard-negative-rows")
    sizes = table.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("a")).first()
    chunks, blocks = -(-sizes["n"] // CHUNK), -(-sizes["a"] // ANCHORS)
    dealt = lambda no, n: F.pmod(F.xxhash64(no), F.lit(max(n, 1))).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(max(n, 1) - 1)))
    candidates = table.select(each(blocks).alias("block"), dealt("no", chunks).alias("chunk"), "id", "label", "v")
    candidates = candidates.groupBy("block", "chunk")

    def meet(anchors: DataFrame, kernel) -> DataFrame:
        copies = anchors.select("*", dealt("a_no", blocks).alias("a_block"), each(chunks).alias("a_chunk"))
        return copies.groupBy("a_block", "a_chunk").cogroup(candidates).applyInArrow(kernel, _KEYS)

    names = {c: F.col(c).alias(f"a_{c}") for c in ("no", "id", "label", "v")}
    anchors = table.where("asks").select(*names.values())
    nearest = Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    chosen = written(meet(anchors, _best_positives(positives)).withColumn("_place", F.row_number().over(nearest))
                     .where(F.col("_place") <= positives).drop("_place"), "hard-negative-positives")
    windows = chosen.groupBy(F.col("no").alias("a_no")).agg(F.collect_list("score").alias("a_scores"))
    near = meet(anchors.join(windows, "a_no"), _best_negatives(negatives, low, high))
    # the tasks and partition counts of the RDD side follow the session's shuffle setting
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = chosen.unionByName(near).rdd.map(lambda r: (sort_key(r[0], r[2], r[3], r[4]), r[1]))
    ordered = keyed.repartitionAndSortWithinPartitions(parts, lambda k: hash((k[0], 0)))
    mined = ordered.mapPartitions(lambda it: emit(it, positives, negatives, low, high))
    return spark.createDataFrame(mined, SCHEMA, verifySchema=False)


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(rows.select("vec_id", "embedding", moved.alias("label")), F.col("vec_id") % 100 == 0)


SQL = """
WITH kept AS (
    SELECT row_number() OVER () AS r, vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
pair AS (
    SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
           coalesce(list_sum([a.v[i] * b.v[i] FOR i IN range(1, least(len(a.v), len(b.v)) + 1)]), 0)::BIGINT AS score
    FROM kept a, kept b WHERE a.vec_id % 100 = 0),
positive AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS p
                   FROM pair WHERE same AND vec_id IS DISTINCT FROM anchor_id) WHERE p <= 5),
mined AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.r, p.p ORDER BY n.score DESC, n.vec_id NULLS LAST) AS rank
    FROM positive p JOIN pair n ON n.r = p.r AND NOT n.same
    AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM mined WHERE rank <= 10
"""
