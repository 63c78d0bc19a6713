"""Fixtures and comparisons shared by the operator tests."""

import re

import duckdb
import pyarrow as pa

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Columns that clash with names used inside the operators.
CLASH = "node string, keep string, label int, _id string, _text string, k int, host string, epoch int, n_chars long"
CLASH_VALUES = ("x", "y", 1, "z", "w", 2, "h", 3, 0)
DOCS = f"doc_id long, text string, lang string, source string, {CLASH}"


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s or "")


def words(s):
    return WORD.findall(lower(s))


def docs(spark, rows):
    """Documents from (doc_id, text[, lang, source]) with clashing extra columns."""
    full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "src1")), *CLASH_VALUES) for r in rows]
    return spark.createDataFrame(full, DOCS)


def duck(sql, **frames):
    """Rows of ``sql`` in DuckDB over the given Spark frames: (sorted columns, sorted rows)."""
    con = duckdb.connect()
    for name, df in frames.items():
        con.register(name, pa.Table.from_batches(df.toArrow().to_batches(), schema=df.toArrow().schema))
    got = con.execute(sql)
    cols = [c[0] for c in got.description]
    return rows_of(cols, got.fetchall())


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted(cols), sorted((tuple(norm(r[i]) for i in order) for r in rows), key=str)


LONG = " ".join(f"word{i % 977} Über{i}" for i in range(1_500))
NOTICE = "This work is licensed under the GNU General Public License, version 3."
EDGES = [
    (None, None), (None, "null id text with several words in it\nline two\nline three"), (1, ""), (2, None), (3, "\n\n"),
    (4, "one"), (5, "Same row\ntwice here\nand three"), (5, "Same row\ntwice here\nand three"),
    (6, "Same row\ntwice here\nand three\nplus a fourth line"), (7, LONG), (7, LONG), (8, "ÄÖÜ MIT\nLicense é MIT license mit LICENSE"),
    (9, NOTICE + "\n" + NOTICE), (9, "another text under the same id"), (10, "a\n\nb\n \nc\na\nb\nc\na\nb\nc", None, None),
    (11, "Released under the MIT License.\r\nx\ty", "fr", "odd name"), (12, "!!! ??? ...", "fr", "src2"),
]
EDGES = [r if len(r) == 4 else (*r, "en", "src1") for r in EDGES]
