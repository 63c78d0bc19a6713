"""Embedding whitening: vectors projected on the leading eigenvectors of their covariance, with unit variance.

How it works. (1) One pass gives the number n of vectors and the exact sum S of each dimension. (2) One pass
gives the covariance: each task centres its vectors by the known mean before it multiplies, and the tasks'
matrices are added in a tree. (3) The covariance, whose size depends on the dimension only, is taken to
tridiagonal form by Householder reflections; Sturm counts bisect for the largest eigenvalues, all at a time;
inverse iteration gives their vectors, where vectors of close eigenvalues are made orthogonal to each other;
the reflections bring them back. (4) Mean and components (d x k numbers) go to the tasks, which project their
rows. (5) The covariance of the projected rows is measured in a pass of its own, from per-task means and
centred products that are merged pairwise, and gives the identity error.

At scale: the driver sees sums and matrices of the dimension, never rows; no pass shuffles rows, so no key
can be hot. Tasks hold one Arrow batch in slices of ``ROWS`` vectors and d x d sums. All passes recompute
from the input when an executor is lost.

Defined results: rows with a null vector or a null or non-finite entry take no part, nor do vectors whose
length isn't the commonest one (of equally common lengths the largest). Scaled entries saturate at 2**52.
``deviation`` is exact, and null where it passes 64 bits. Eigenvalues below ``RANK`` times the largest can't
be told from zero in double precision: such components have no rows (all of them if no dimension varies).
The entry of largest size of a component is positive; equal eigenvalues give any orthonormal basis of
their space. Null and repeated ids and repeated rows are rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
ROWS = 4_096
RANK = 1e-10
MOST = 1 << 52

SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


# ---------------------------------------------------------------- eigenvectors of a symmetric matrix

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and unit Householder vectors with Q' a Q tridiagonal, Q = H0 H1 ..."""
    a = np.array(a, dtype=np.float64)
    n = len(a)
    mirrors = []
    for k in range(n - 2):
        x = a[k + 1:, k]
        size = np.abs(x).max()
        v = np.zeros(n - k - 1)
        if size > 0:
            v = x / size
            v[0] += np.copysign(np.linalg.norm(v), v[0])
            v /= np.linalg.norm(v)
            block = a[k + 1:, k + 1:]
            p = block @ v
            w = 2.0 * (p - (v @ p) * v)
            block -= np.outer(v, w) + np.outer(w, v)
            x -= 2.0 * v * (v @ x)
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def counts_below(d: np.ndarray, e: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues of the tridiagonal matrix lie below each point."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps * max(1.0, float(np.max(e * e, initial=0.0)))
    q, below = d[0] - points, np.zeros(len(points), np.int64)
    for i in range(len(d)):
        if i:
            q = d[i] - points - e[i - 1] ** 2 / q
        q = np.where(np.abs(q) < tiny, -tiny, q)  # a pivot of no size counts as a negative one
        below += q < 0
    return below


def largest_eigenvalues(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected until its interval can't be halved."""
    n = len(d)
    radius = np.concatenate([np.abs(e), [0.0]]) + np.concatenate([[0.0], np.abs(e)])
    low = np.full(k, (d - radius).min())
    high = np.full(k, (d + radius).max())
    low, high = low - np.spacing(np.abs(low)) * n, high + np.spacing(np.abs(high)) * n
    index = np.arange(n - 1, n - k - 1, -1)  # from 0, rising
    while True:
        mid = low + (high - low) / 2
        open_ = (mid > low) & (mid < high)
        if not open_.any():
            return mid
        above = counts_below(d, e, mid) <= index
        low, high = np.where(open_ & above, mid, low), np.where(open_ & ~above, mid, high)


def _solve(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray, floor: float) -> np.ndarray:
    """(T - shift) x = b by elimination with row exchanges; pivots of no size become ``floor``."""
    n = len(d)
    u, u1, u2, x = d - shift, np.append(e, 0.0), np.zeros(n), b.copy()
    for i in range(n - 1):
        under, nxt = e[i], u[i + 1]
        nxt1 = u1[i + 1]
        if abs(under) > abs(u[i]):
            u[i], u1[i], u2[i], under, nxt, nxt1 = under, nxt, nxt1, u[i], u1[i], 0.0
            x[i], x[i + 1] = x[i + 1], x[i]
        if abs(u[i]) < floor:
            u[i] = floor
        f = under / u[i]
        u[i + 1], u1[i + 1] = nxt - f * u1[i], nxt1 - f * u2[i]
        x[i + 1] -= f * x[i]
    if abs(u[-1]) < floor:
        u[-1] = floor
    for i in range(n - 1, -1, -1):
        x[i] = (x[i] - (u1[i] * x[i + 1] if i + 1 < n else 0.0) - (u2[i] * x[i + 2] if i + 2 < n else 0.0)) / u[i]
        if abs(x[i]) > 1e150:
            x /= abs(x[i])
    return x


def inverse_iteration(d: np.ndarray, e: np.ndarray, values: np.ndarray, steps: int = 6) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix, one column a value; close values' vectors are orthogonalised.

    A value belongs to its predecessor's cluster if the two differ by less than a thousandth of the matrix's norm.
    """
    n = len(d)
    norm = max(float(np.max(np.abs(d), initial=0.0) + 2 * np.max(np.abs(e), initial=0.0)), np.finfo(float).tiny)
    floor = np.finfo(float).eps * norm
    out, rng, begin = np.zeros((n, len(values))), np.random.default_rng(7), 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            begin = j
        cluster = out[:, begin:j]
        shift = value - (j - begin) * 2 * floor  # equal values get shifts of their own
        x = rng.standard_normal(n)
        for _ in range(steps):
            x = _solve(d, e, shift, x, floor)
            for _ in range(2):
                x = x - cluster @ (cluster.T @ x)
            x /= np.linalg.norm(x)
        out[:, j] = x
    return out


def leading_eigenvectors(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    n = len(a)
    size = float(np.max(np.abs(a), initial=0.0))
    if not n or not k or size == 0.0:
        return np.zeros(min(k, n)), np.eye(n)[:, : min(k, n)]
    d, e, mirrors = tridiagonal(a / size)
    values = largest_eigenvalues(d, e, min(k, n))
    vectors = inverse_iteration(d, e, values)
    for j in range(len(mirrors) - 1, -1, -1):
        v, part = mirrors[j], vectors[j + 1:]
        part -= 2.0 * np.outer(v, v @ part)
    vectors /= np.linalg.norm(vectors, axis=0)
    top = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
    return values * size, vectors * np.where(top < 0, -1.0, 1.0)


# ---------------------------------------------------------------- rows of a batch

def scaled(vectors: pa.Array, d: int) -> np.ndarray:
    """Integer vectors ``floor(64 c) + 1000000`` of a list array whose lists all have ``d`` entries."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.clip(np.floor(SCALE * flat), -MOST, MOST).astype(np.int64).reshape(len(vectors), d) + SHIFT


def deviations(x: np.ndarray, n: int, whole: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum over dimensions of ``(n x - S) ** 2``, exactly, and whether 64 bits hold it."""
    part = x - whole
    widest = n * (int(np.abs(part).max(initial=0)) + 1)
    if x.shape[1] * widest * widest < 1 << 63:
        return ((n * part - rest) ** 2).sum(axis=1), np.ones(len(x), bool)
    exact = ((part.astype(object) * n - rest.astype(object)) ** 2).sum(axis=1)
    fits = np.array([v < 1 << 63 for v in exact], bool)
    return np.where(fits, exact, 0).astype(np.int64), fits


def _slices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            some = batch.slice(i, ROWS)
            yield some.column(0), scaled(some.column(1), d)


# ---------------------------------------------------------------- passes over the table

def vectors_of(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part, vectors as doubles."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(F.col(vector).isNotNull()).where(F.coalesce(fine, F.lit(False)) & (F.size(vector) > 0)).select(
        F.col(key).cast("long").alias("id"), v.alias("v"))


def total(rows: DataFrame, d: int) -> tuple[int, np.ndarray]:
    """Number of rows and exact sums of the scaled dimensions (decimals, then Python's integers)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * d
        for _, x in _slices(batches, d):
            n += len(x)
            sums = [a + int(b) for a, b in zip(sums, x.sum(axis=0))]
        yield pa.RecordBatch.from_pydict({"dim": pa.array([-1, *range(d)], pa.int32()), "part": [str(n), *map(str, sums)]})

    parts = rows.mapInArrow(run, "dim int, part string")
    got = parts.groupBy("dim").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("s")).collect()  # d + 1 rows
    by = {r["dim"]: int(r["s"]) for r in got}
    return by.get(-1, 0), np.array([by.get(i, 0) for i in range(d)], dtype=object)


Moments = tuple[int, np.ndarray, np.ndarray]


def merged(a: Moments, b: Moments) -> Moments:
    """Count, mean and centred products of two parts together."""
    if not a[0] or not b[0]:
        return a if a[0] else b
    n, step = a[0] + b[0], b[1] - a[1]
    return n, a[1] + step * (b[0] / n), a[2] + b[2] + np.outer(step, step) * (a[0] / n * b[0])


def covariance(rows: DataFrame, d: int, width: int, project) -> np.ndarray:
    """Covariance (divisor n) of ``project(x)``, which has ``width`` columns, over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Moments = (0, np.zeros(width), np.zeros((width, width)))
        for _, x in _slices(batches, d):
            y = project(x)
            mean = y.mean(axis=0)
            y = y - mean
            held = merged(held, (len(y), mean, y.T @ y))
        yield pa.RecordBatch.from_pydict({"n": [held[0]], "mean": [held[1].tobytes()], "m2": [held[2].tobytes()]})

    def read(r) -> Moments:
        return r[0], np.frombuffer(r[1]), np.frombuffer(r[2]).reshape(width, width)

    n, _, m2 = rows.mapInArrow(run, "n long, mean binary, m2 binary").rdd.map(read).treeReduce(merged, depth=3)
    return m2 / n


@dataclass
class Whitening:
    """What tasks need to project a row: sizes by the dimension and the number of components only."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def __post_init__(self):
        self.whole = np.array([int(s) // self.n for s in self.sums], np.int64)
        self.rest = np.array([int(s) % self.n for s in self.sums], np.int64)

    def centre(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n``: whole steps exactly, then the fraction."""
        return (x - self.whole) - self.rest / self.n

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centre(x) @ (self.vectors / np.sqrt(self.values))


def fit_whitening(rows: DataFrame, d: int, components: int) -> Whitening | None:
    """Passes 1 to 3 over (id, v) rows of ``d`` entries; None if there are none."""
    n, sums = total(rows, d)
    if not n:
        return None
    model = Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0)
    v = covariance(rows, d, d, model.centre)
    values, vectors = leading_eigenvectors(v, min(components, d))
    told = (values > RANK * max(values[0], 0.0)) & (values > 0)
    model.values, model.vectors, model.trace = values[told], vectors[:, told], float(np.trace(v))
    return model


def whiten(rows: DataFrame, *, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``SCHEMA`` rows: one for each remaining row and component, components from 1 by falling eigenvalue."""
    spark = rows.sparkSession
    kept = vectors_of(rows, key, vector)
    lengths = kept.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], SCHEMA)
    d = lengths["d"]
    kept = kept.where(F.size("v") == d)
    model = fit_whitening(kept, d, components)
    k = len(model.values)
    if not k:
        return spark.createDataFrame([], SCHEMA)
    error = float(np.abs(covariance(kept, d, k, model.project) - np.eye(k)).max())
    explained = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _slices(batches, d):
            sums, fits = deviations(x, model.n, model.whole, model.rest)
            m = len(x)
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n, np.int64)), pa.array(np.repeat(sums, k), mask=np.repeat(~fits, k)),
                pa.array(model.project(x).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return kept.mapInArrow(run, SCHEMA)


def op11_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
