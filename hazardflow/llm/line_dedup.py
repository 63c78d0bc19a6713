"""Line dedup: repeated three-line windows are found globally, and later occurrences are cut out.

Lines are what ``\\n`` separates. Blank lines (only white space) belong to no window, so they neither
make a repeat nor hide one. Each run of three consecutive non-blank lines of a document is a window,
keyed by a 128-bit hash of its lines. Of equal windows the first stays, in the order (document id,
MD5 of the text, line number), nulls first; every later occurrence covers its three lines, overlapping covers
merge, and covered lines go. Lines outside every cover stay as they are, blank ones included.

At scale: windows are (hash, id, place) rows; their first occurrence is a partially aggregated minimum,
so a window that a third of all documents share costs one row a task, and joining it back is an
equi-join whose large partitions Spark can split. Only (document, places) of later occurrences meet the
texts again, by a sort-merge join that can spill.

Defined results: null text stays null; documents of fewer than three non-blank lines stay whole; rows
with equal id and equal text count as one document (its own windows are one occurrence) and are cut
alike; null ids sort first; all columns of the input pass through unchanged but the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import text_of

WINDOW = 3


def identity(key: Column, text: Column) -> list[Column]:
    """What tells documents apart and orders them: id, 60 bits of MD5 (any engine can repeat them), 64 further bits."""
    leading = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
    return [key.alias("_id"), leading.alias("_h"), F.xxhash64(text).alias("_g")]


def _full(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, r"[\t\r\x0B\f]+", " ")) != ""


def windows(rows: DataFrame, n: int = WINDOW) -> DataFrame:
    """(_id, _h, _g, place, w1, w2) of every run of ``n`` non-blank lines, numbered from 0 by its first one.

    Each line is hashed to two longs where the text is split, and windows are made of these longs, so no row
    holds a line twice. Rows with equal id and text appear once for every copy.
    """
    hashed = F.transform(F.split("_text", "\n"), lambda line: F.when(_full(line), F.struct(
        F.xxhash64(line).alias("a"), F.xxhash64(F.lit(n), line).alias("b"))))
    lines = rows.select("_id", "_h", "_g", F.array_compact(hashed).alias("_lines"))
    starts = F.when(F.size("_lines") >= n, F.sequence(F.lit(0), F.size("_lines") - n)).otherwise(F.array().cast("array<int>"))
    pair = F.transform(starts, lambda i: F.struct(
        i.alias("place"), F.xxhash64(*[F.get("_lines", i + k)["a"] for k in range(n)]).alias("w1"),
        F.xxhash64(*[F.get("_lines", i + k)["b"] for k in range(n)]).alias("w2")))
    return lines.select("_id", "_h", "_g", F.inline(pair))


def later_windows(rows: DataFrame, n: int = WINDOW) -> DataFrame:
    """(_id, _h, _g, cut): where later occurrences start, one row a document that has any."""
    occ = windows(rows, n)
    at = F.struct("_id", "_h", "_g", "place")
    first = occ.groupBy("w1", "w2").agg(F.min(at).alias("first"), F.max(at).alias("last")).where(
        ~F.col("first").eqNullSafe(F.col("last")))
    later = occ.join(first.select("w1", "w2", "first"), ["w1", "w2"]).where(~at.eqNullSafe(F.col("first")))
    return later.groupBy("_id", "_h", "_g").agg(F.collect_set("place").alias("cut"))


def _without(body: Column, cut: Column, n: int) -> Column:
    """(text, n_removed): ``body`` without the lines of the windows that start at the places ``cut``."""
    parts = F.split(body, "\n")
    numbers = F.array_compact(F.transform(parts, lambda line, i: F.when(_full(line), i)))
    named = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))  # noqa: E731  made once, used twice
    gone = lambda s: F.array_distinct(F.flatten(F.transform(
        cut, lambda p: F.array(*[F.get(s["numbers"], p + k) for k in range(n)]))))  # slice() would copy the whole array each time
    left = lambda s: F.transform(F.array_except(F.sequence(F.lit(0), F.size(s["parts"]) - 1), s["gone"]),
                                 lambda i: F.get(s["parts"], i))
    numbered = named(F.struct(parts.alias("parts"), numbers.alias("numbers")),
                     lambda s: F.struct(s["parts"].alias("parts"), gone(s).alias("gone")))
    return named(numbered, lambda s: F.struct(F.array_join(left(s), "\n").alias("text"), F.size(s["gone"]).alias("n_removed")))


def drop_repeated_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text", n: int = WINDOW,
                        report: bool = False) -> DataFrame:
    """``docs`` with covered lines removed from ``text``; with ``report`` (key, text, n_lines, n_removed) instead."""
    known = identity(F.col(key), text_of(F.col(text)))
    cut = later_windows(docs.select(*known, text_of(F.col(text)).alias("_text")), n).select(
        F.col("_id").alias("_ci"), F.col("_h").alias("_ch"), F.col("_g").alias("_cg"), "cut")
    columns = [key, text] if report else docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), *known)
    joined = packed.join(cut, F.col("_id").eqNullSafe(F.col("_ci")) & (F.col("_h") == F.col("_ch")) & (F.col("_g") == F.col("_cg")), "left")
    body = F.col("_row").getField(text)
    done = joined.select("_row", F.when(F.col("cut").isNotNull() & body.isNotNull(), _without(body, F.col("cut"), n)).alias("_new"))
    cleaned = F.coalesce(F.col("_new.text"), body)
    if report:
        lines = F.when(body.isNull(), F.lit(0)).otherwise(F.length(body) - F.length(F.translate(body, "\n", "")) + 1)
        return done.select(F.col("_row").getField(key).alias(key), cleaned.alias("text"), lines.alias("n_lines"),
                           F.coalesce("_new.n_removed", F.lit(0)).alias("n_removed"))
    return done.select(*[(cleaned if c == text else F.col("_row").getField(c)).alias(c) for c in docs.columns])


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"), report=True)


SQL = r"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
kind AS (SELECT DISTINCT doc_id, coalesce(text, '') AS body FROM doc),
line AS (SELECT doc_id, body, unnest(string_split(body, chr(10))) AS line,
                unnest(range(0, len(string_split(body, chr(10))))) AS no FROM kind),
full_line AS (SELECT *, row_number() OVER (PARTITION BY doc_id, body ORDER BY no) AS k FROM line
              WHERE trim(regexp_replace(line, '[\t\r\x0B\f]+', ' ', 'g')) <> ''),
win AS (SELECT doc_id, body, k, line AS a, lead(line) OVER d AS b, lead(line, 2) OVER d AS c
        FROM full_line WINDOW d AS (PARTITION BY doc_id, body ORDER BY k)),
occ AS (SELECT doc_id, body, k, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id NULLS FIRST, ('0x' || md5(body)[:15])::BIGINT, body, k) AS nth
        FROM win WHERE c IS NOT NULL),
cover AS (SELECT DISTINCT doc_id, body, k + d AS k FROM occ, (VALUES (0), (1), (2)) t(d) WHERE nth > 1),
gone AS (SELECT f.doc_id, f.body, f.no FROM full_line f JOIN cover c
         ON f.doc_id IS NOT DISTINCT FROM c.doc_id AND f.body = c.body AND f.k = c.k),
kept AS (SELECT l.doc_id, l.body, string_agg(l.line, chr(10) ORDER BY l.no) FILTER (WHERE g.no IS NULL) AS text,
                count(*) AS n_lines, count(g.no) AS n_removed
         FROM line l LEFT JOIN gone g ON l.doc_id IS NOT DISTINCT FROM g.doc_id AND l.body = g.body AND l.no = g.no
         GROUP BY l.doc_id, l.body)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       CASE WHEN d.text IS NULL THEN 0 ELSE n_lines END::INTEGER AS n_lines, n_removed::INTEGER AS n_removed
FROM doc d JOIN kept k ON d.doc_id IS NOT DISTINCT FROM k.doc_id AND coalesce(d.text, '') = k.body
"""
