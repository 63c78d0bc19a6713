"""Benchmark decontamination: multi-pattern search of benchmark windows in documents (Wu-Manber on words).

Patterns are all runs of ``window`` consecutive words of an item; an item with fewer words, but not
none, is one pattern. Patterns of one length share a table: for every block of two words, how far the
search may jump when that block ends at the current word (0 if the block ends a pattern, the whole length
less one if no pattern has it). The search looks at one block, jumps, and only where the jump is 0 takes
the patterns that end in that block from a hash bucket, compares their word hashes and at last their text.
Texts are searched in segments that run side by side in array operations, so a very long text costs no
more steps than a short one.

The pattern tables are broadcast; at most ``max_patterns`` patterns are held at a time, and a larger
benchmark is searched in as many passes as it needs (patterns are dealt to passes by hash), whose
results are merged per document. Documents are scanned once a pass and never shuffled whole.

Defined results: null or empty texts have no words and are clean; items without words match nothing;
items with a null id are left out; a document word inside any occurrence is hit once, however many
patterns cover it; repeated rows are judged alike; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .batches import Words, mix, slices
from .columns import text_of, words

WINDOW = 10
MAX_PATTERNS = 1 << 20
SEGMENT = 512  # words that one search lane covers
_TABLE_BITS = 20


class PatternTable:
    """Shift table and suffix buckets of patterns of one length (in words)."""

    def __init__(self, length: int, texts: list[bytes], items: list[list[str]]):
        self.length, self.texts, self.items = length, texts, items
        self.block = min(2, length)
        rows = Words(pa.array([t.decode("utf-8") for t in texts])).hashes.reshape(len(texts), length)
        shift = np.full(1 << _TABLE_BITS, length - self.block + 1, np.int32)
        for j in range(self.block - 1, length):
            np.minimum.at(shift, self._slot(rows[:, j - 1] if self.block == 2 else None, rows[:, j]), length - 1 - j)
        self.shift = shift
        suffix = self._code(rows[:, -2] if self.block == 2 else None, rows[:, -1])
        self.order = np.argsort(suffix, kind="stable")
        self.suffix, self.rows = suffix[self.order], rows[self.order]

    @staticmethod
    def _code(before: np.ndarray | None, last: np.ndarray) -> np.ndarray:
        return mix(last if before is None else before * np.uint64(0x9E3779B97F4A7C15) + last)

    def _slot(self, before, last) -> np.ndarray:
        return (self._code(before, last) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def search(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(word where an occurrence begins, pattern) of all occurrences in the texts of ``w``."""
        h, n = w.hashes, self.length
        spans = np.maximum(w.counts - n + 1, 0)  # window ends per text
        lanes = -(-spans // SEGMENT)
        text = np.repeat(np.arange(len(spans)), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = w.first[:-1][text] + n - 1 + nth * SEGMENT
        stop = np.minimum(at + SEGMENT, w.first[1:][text])
        begins, found = [], []
        while len(at):
            before, last = (h[at - 1] if self.block == 2 else None), h[at]
            code = self._code(before, last)
            jump = self.shift[(code >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)]
            here = jump == 0
            if here.any():
                ends, key = at[here], code[here]
                lo = np.searchsorted(self.suffix, key, "left")
                size = np.searchsorted(self.suffix, key, "right") - lo
                ends, row = np.repeat(ends, size), np.repeat(lo, size) + (
                    np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))
                for k in range(n):  # compare word by word, keep what still agrees
                    same = h[ends - n + 1 + k] == self.rows[row, k]
                    ends, row = ends[same], row[same]
                for e, r in zip(ends.tolist(), self.order[row].tolist()):
                    if w.text_at(e - n + 1, n) == self.texts[r]:
                        begins.append(e - n + 1)
                        found.append(r)
            at = at + np.maximum(jump, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        return np.array(begins, np.int64), np.array(found, np.int64)


def _search_slice(texts: pa.Array, tables: list[PatternTable]) -> tuple[np.ndarray, list[list[int]], list[list[str]]]:
    """Per text: number of words, word places that are hit, ids of items found."""
    w = Words(texts)
    hit = np.zeros(len(w.hashes), bool)
    items: list[set[str]] = [set() for _ in range(len(texts))]
    for table in tables:
        begins, found = table.search(w)
        for k in range(table.length):
            hit[begins + k] = True
        owner = np.searchsorted(w.first, begins, "right") - 1
        for d, p in zip(owner.tolist(), found.tolist()):
            items[d].update(table.items[p])
    places: list[list[int]] = [[] for _ in range(len(texts))]
    marked = np.flatnonzero(hit)
    owner = np.searchsorted(w.first, marked, "right") - 1
    for d in np.unique(owner):
        places[d] = (marked[owner == d] - w.first[d]).tolist()
    return w.counts, places, [sorted(s) for s in items]


def patterns_of(benchmark: DataFrame, window: int, *, key: str = "item_id", text: str = "text") -> DataFrame:
    """(pattern, n, items): distinct windows with the ids of their items as strings."""
    w = benchmark.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("item"), words(F.col(text)).alias("w"))
    w = w.where(F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(window)))
    runs = w.select("item", "n", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("w") - F.col("n") + 1), lambda i: F.array_join(F.slice("w", i, F.col("n")), " "))).alias("pattern"))
    return runs.groupBy("pattern", "n").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _one_pass(docs: DataFrame, tables: list[PatternTable], schema: str, every: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(tables)  # bounded by max_patterns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            for lo, hi in slices(texts):
                counts, places, items = _search_slice(texts.slice(lo, hi - lo), shared.value)
                out = pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(counts, pa.int64()),
                    pa.array(places, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
                    names=["_id", "_h", "n_words", "hits", "items"])
                yield out if every else out.filter(pa.array([bool(p) for p in places]))

    return docs.mapInArrow(run, schema)


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text",
                       item_key: str = "item_id", window: int = WINDOW, max_patterns: int = MAX_PATTERNS) -> DataFrame:
    """(_id, _h, n_words, hits, items) per document: hit word places and found item ids; ``_h`` hashes the text."""
    ship_package(docs.sparkSession)
    patterns = patterns_of(benchmark, window, key=item_key)
    passes = max(1, -(-patterns.count() // max_patterns))
    rows = docs.select(F.col(key).alias("_id"), F.xxhash64(text_of(F.col(text))).alias("_h"), text_of(F.col(text)).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()
    schema = f"_id {id_type}, _h long, n_words long, hits array<int>, items array<string>"

    def tables(nth: int) -> list[PatternTable]:
        by_length: dict[int, tuple[list[bytes], list[list[str]]]] = {}
        part = patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(passes)) == nth)
        for r in part.collect():  # about max_patterns rows
            texts, items = by_length.setdefault(r["n"], ([], []))
            texts.append(r["pattern"].encode("utf-8"))
            items.append(list(r["items"]))
        return [PatternTable(n, *x) for n, x in sorted(by_length.items())]

    out = _one_pass(rows, tables(0), schema, every=True)
    if passes == 1:
        return out
    more = None
    for nth in range(1, passes):
        found = _one_pass(rows, tables(nth), schema, every=False)
        more = found if more is None else more.unionByName(found)
    more = more.distinct().groupBy(F.col("_id").alias("_i"), F.col("_h").alias("_g")).agg(
        F.flatten(F.collect_list("hits")).alias("_hits"), F.flatten(F.collect_list("items")).alias("_items"))
    merged = out.join(more, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_g")), "left")
    return merged.select("_id", "_h", "n_words",
                         F.when(F.col("_hits").isNull(), F.col("hits")).otherwise(
                             F.array_sort(F.array_union("hits", "_hits"))).alias("hits"),
                         F.when(F.col("_items").isNull(), F.col("items")).otherwise(
                             F.array_sort(F.array_union("items", "_items"))).alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without those in which a benchmark window occurs."""
    bad = find_contamination(docs, benchmark, key=key, text=text, **options).where(F.size("hits") > 0).select("_id", "_h").distinct()
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(key).alias("_k"),
                         F.xxhash64(text_of(F.col(text))).alias("_g"))
    kept = packed.join(bad, F.col("_k").eqNullSafe(F.col("_id")) & (F.col("_g") == F.col("_h")), "left_anti")
    return kept.select("_row.*")


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    n_hit = F.size("hits").cast("long")
    return find_contamination(docs, benchmark).select(
        F.col("_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


SQL = r"""
WITH it AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
pat AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') AS p
        FROM (SELECT *, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS i FROM it WHERE len(w) > 0)),
doc AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
win AS (SELECT r, n, i, array_to_string(w[i + 1 : i + n], ' ') AS p
        FROM (SELECT r, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM doc, (SELECT DISTINCT n FROM pat) WHERE len(w) >= n)),
occ AS (SELECT r, i, win.n, item FROM win JOIN pat ON win.p = pat.p AND win.n = pat.n),
hit AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM (SELECT r, i, unnest(range(0, n)) AS k FROM occ) GROUP BY r),
its AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM occ GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""
