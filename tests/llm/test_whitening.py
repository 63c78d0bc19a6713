"""Whitening against numpy on the tables and on odd matrices; edge cases of the query."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardflow.llm import whitening as w

NAN, INF = float("nan"), float("inf")
ROWS = "vec_id long, embedding array<float>, label int, n long, v string, id int, component int"
RNG = np.random.default_rng(3)


def orthogonal(n):
    return np.linalg.qr(RNG.standard_normal((n, n)))[0]


MATRICES = {
    "one": np.array([[2.5]]), "two": np.array([[2.0, 1.0], [1.0, 2.0]]), "zero": np.zeros((4, 4)), "eye": np.eye(40), "ones": np.ones((30, 30)),
    "random": np.cov(RNG.standard_normal((50, 200))), "repeated": np.diag(np.repeat([3.0, 2.0, 1.0], 20)),
    "close": (lambda q: (q * np.repeat([5, 5 - 1e-9, 1, 1e-3], 16)) @ q.T)(orthogonal(64)),
    "wide": (lambda q: (q * np.logspace(0, -14, 64)) @ q.T)(orthogonal(64)),
    "glued": np.diag(np.abs(np.arange(-20, 21)).astype(float)) + np.diag(np.ones(40), 1) + np.diag(np.ones(40), -1),
    "huge": 1e200 * np.cov(RNG.standard_normal((10, 30))), "small": 1e-200 * np.cov(RNG.standard_normal((10, 30))),
}


@pytest.mark.parametrize("name", MATRICES)
def test_eigenvectors(name):
    a = MATRICES[name]
    k = min(32, len(a))
    values, q = w.leading_eigenvectors(a, k)
    size = max(float(np.abs(a).max()), 1e-300)
    np.testing.assert_allclose(values / size, np.linalg.eigvalsh(a)[::-1][:k] / size, atol=1e-13)
    np.testing.assert_allclose(q.T @ q, np.eye(k), atol=1e-12)
    np.testing.assert_allclose(a @ q / size, q * values / size, atol=1e-12)


def test_sturm_counts_equal_the_number_of_smaller_eigenvalues():
    d, e = RNG.standard_normal(30), RNG.standard_normal(29)
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    points = np.linspace(-6, 6, 101)
    assert w.counts_below(d, e, points).tolist() == [int((values < p).sum()) for p in points]


def brute(vectors, k=32):
    """By numpy: exact integers, mean, covariance; eigenvalues from LAPACK."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    away = np.array([[(n * c - s) / n for c, s in zip(r, sums)] for r in x])
    values, q = np.linalg.eigh(away.T @ away / n)
    dev = [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x]
    return away, values[::-1][:k], q[:, ::-1][:, :k], dev, values.sum()


def check(rows, vectors, ids, k):
    away, values, q, dev, trace = brute(vectors, k)
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert set(by) == set(ids) and all(sorted(c) == list(range(1, k + 1)) for c in by.values())
    assert {r.n for r in rows} == {len(vectors)}
    got = np.array([[by[i][c + 1].whitened for c in range(k)] for i in ids])
    want = away @ q / np.sqrt(values)
    np.testing.assert_allclose(np.abs(got), np.abs(want), atol=1e-6)
    np.testing.assert_allclose((got * want).sum(axis=0) / (want * want).sum(axis=0), np.sign((got * want).sum(axis=0)), atol=1e-6)
    np.testing.assert_allclose([by[ids[0]][c + 1].explained for c in range(k)], values / trace, rtol=1e-9)
    error = np.abs(np.cov(got.T, bias=True).reshape(k, k) - np.eye(k)).max()
    assert [by[i][1].deviation for i in ids] == dev and abs(rows[0].identity_error - error) < 1e-9 and error < 1e-9


def test_equals_numpy_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = w.op11_embedding_whitening(spark, "/root/testdata/sf0.001").collect()
    given = {r.vec_id: r.embedding for r in table.collect()}
    check(rows, list(given.values()), list(given), 32)


def test_edge_cases(spark, tmp_path):
    fine = [(i, [float(v) for v in RNG.standard_normal(5)]) for i in range(60)] + [(100, [0.5, -0.5, 1e4, 0.0, 3.0])]
    odd = [(201, None), (202, [1.0, None, 1.0, 1.0, 1.0]), (203, [NAN] * 5), (204, [INF, 1.0, 1.0, 1.0, 1.0]), (205, []), (206, [1.0, 2.0])]
    spark.createDataFrame([(*r, 1, 5, "x", 7, 9) for r in fine + odd], ROWS).write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = w.op11_embedding_whitening(spark, str(tmp_path)).collect()
    given = {r.vec_id: r.embedding for r in spark.read.parquet(f"{tmp_path}/embeddings.parquet").where(F.size("embedding") == 5).collect()
             if r.vec_id <= 100}
    check(rows, list(given.values()), list(given), 5)


def test_repeated_rows_null_ids_and_dimensions_without_variance(spark):
    rows = [(None, [1.0, 2.0, 7.0])] * 3 + [(1, [2.0, 4.0, 7.0])] * 2 + [(1, [3.0, 1.0, 7.0]), (2, [5.0, 2.0, 7.0])]
    got = w.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 7 * 2 and {r.component for r in got} == {1, 2} and sum(r.vec_id is None for r in got) == 6
    assert got[0].identity_error < 1e-12 and abs(sum({r.component: r.explained for r in got}.values()) - 1) < 1e-12


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])]])
def test_no_variance_gives_no_rows(spark, rows):
    got = w.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got.collect() == [] and got.columns[:3] == ["vec_id", "component", "n"]


def test_deviation_is_exact_or_null(spark):
    rows = [(i, [float(i) * 2.0 ** 20, 1.0]) for i in range(8)] + [(9, [2.0 ** 45, 1.0])]
    got = {r.vec_id: r.deviation for r in w.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), components=1).collect()}
    x = [math.floor(64 * r[1][0]) for r in rows]
    want = [(9 * c - sum(x)) ** 2 for c in x]
    assert [got[r[0]] for r in rows] == [v if v < 1 << 63 else None for v in want]
