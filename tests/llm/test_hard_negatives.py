"""Hard-negative mining against DuckDB on the tables and on edge cases; cells, windows and the stream by themselves."""

import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import duck, spark_rows
from pyspark.sql import functions as F

from hazardflow.llm import hard_negatives as h

NAN, INF = float("nan"), float("inf")
ROWS = "vec_id long, embedding array<float>, label int, no long, v string, score double, block int, kind int"
EXTRA = (7, "x", 0.5, 3, 1)


def table(spark, tmp_path, rows, schema=ROWS):
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], schema)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    return spark.read.parquet(f"{tmp_path}/embeddings.parquet")


def some_rows(n, d=6, labels=3, seed=1):
    rnd = random.Random(seed)
    return [(i, [rnd.choice((-0.5, 0.25, 0.5, 1.0)) for _ in range(d)], rnd.randrange(labels)) for i in range(n)]


def test_equals_sql_with_ties_and_many_cells(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(h, "CHUNK", 64)
    monkeypatch.setattr(h, "ANCHORS", 2)
    df = table(spark, tmp_path, some_rows(900))
    got = spark_rows(h.op13_hard_negatives(spark, str(tmp_path)))
    assert got == duck(h.SQL, embeddings=df.select("vec_id", "embedding", "label")) and len(got[1]) > 100


def test_edge_cases(spark, tmp_path):
    odd = [(100, None, 1), (200, [1.0, None], 1), (300, [NAN, 1.0], 1), (400, [INF, 1.0], 1), (500, [1.0, 2.0], None), (600, [], 1),
           (700, [1.0, 0.5, 0.25], 1), (700, [1.0, 0.5, 0.25], 1), (800, [-1.0, -1.0], 2), (None, [1.0, 1.0], 1), (None, [0.5, 0.5], 0),
           (7, [0.75, 0.5], 0), (14, [0.5, 0.25], 9), (-100, [1.0, 1.0], 1), (900, [3.0], 5), (1, [0.0, 0.0], 0), (2, [0.0], 1)]
    df = table(spark, tmp_path, odd + [(i, [0.5, 0.125 * (i % 9)], i % 3) for i in range(1001, 1061)])
    got = spark_rows(h.op13_hard_negatives(spark, str(tmp_path)))
    assert got == duck(h.SQL, embeddings=df.select("vec_id", "embedding", "label"))
    assert {r[0] for r in got[1]} >= {-100, 700} and not {r[0] for r in got[1]} & {100, 200, 300, 400, 500}


@pytest.mark.parametrize("rows", [[], [(100, [1.0], 1)], [(100, None, None)]])
def test_few_rows(spark, tmp_path, rows):
    table(spark, tmp_path, rows)
    out = h.op13_hard_negatives(spark, str(tmp_path))
    assert out.collect() == [] and out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_huge_components_are_exact_or_saturate(spark):
    big = float(2 ** 40)
    df = spark.createDataFrame([(100, [big, 1.0], 1), (1, [big, 1.0], 1), (2, [big / 2, 3.0], 0), (3, [1e300, 1.0], 0), (4, [1e300, 1.0], 1)],
                               "vec_id long, embedding array<double>, label int")
    got = h.mine_hard_negatives(df, F.col("vec_id") == 100, scale=1).collect()
    top = [r for r in got if r.positive_id == 4]
    assert all(r.positive_score == h.MOST for r in top)
    exact = [float(2 ** 30), 1.0], [float(2 ** 30), 3.0]
    a, b = (np.array([[int(x) for x in v]], np.int64) for v in exact)
    assert h.scores(a, b)[0, 0] == 2 ** 60 + 3


def test_window_bounds_are_exact():
    for score in range(-50, 200):
        low, high = h.window_of(score, 30, 90)
        inside = [s for s in range(-200, 300) if 30 * score <= 100 * s <= 90 * score]
        assert inside == list(range(low, high + 1))


def test_stream_holds_one_anchor_and_ignores_more_positives_than_asked():
    keys = sorted([(h.sort_key(1, 100, 0, 5), 10), (h.sort_key(1, 90, 0, 6), 10), (h.sort_key(1, 80, 0, 7), 10),
                   (h.sort_key(1, 81, 1, 8), 10), (h.sort_key(1, 40, 1, None), 10), (h.sort_key(1, 40, 1, 9), 10), (h.sort_key(2, 5, 1, 9), 20)])
    got = list(h.emit(iter(keys), 2, 2, 30, 90))
    assert got == [(10, 5, 1, 8, 100, 81), (10, 6, 1, 8, 90, 81), (10, 5, 2, 9, 100, 40), (10, 6, 2, 9, 90, 40)]


def test_matrix_of_sliced_ragged_lists():
    lists = pa.chunked_array([pa.array([[9], [1, 2], []], pa.list_(pa.int64())).slice(1), pa.array([[3, 4, 5]], pa.list_(pa.int64()))])
    assert h.matrix(lists).tolist() == [[1, 2, 0], [0, 0, 0], [3, 4, 5]]
