"""Random survival forest, grown level by level for all trees at once (RSF-1..5).

Rows are binned once: features by quantile edges, time by quantile edges. A row's bootstrap weight in a tree
is Poisson(1), read from a hash of (seed, tree, id), so in-bag and out-of-bag rows can be told again at any time
without storing them. The features a node may split on come from a hash of (seed, tree, node).

Rows of the same bins, time bin and event are one cell to a tree, with their number and their weight: rows are sorted by
cell, and each block of them is counted for all trees at once on arrays. If there are ``TREE_CELLS`` cells or fewer
(bins bound them, not rows), a tree grows from its cells in one task, by the rules below; otherwise it grows from rows.

One level: every in-bag row gives one record for each feature of its node; one ``groupBy(tree, node, feature,
bin)`` counts rows, weights at risk and deaths by time bin (time bins are columns); a running sum over the at most
``bins`` rows of a node's feature gives every cut's left side, and the log-rank statistic of the cut is an
expression over the time bins; the best cut of each node is an aggregate. The split table, one row a split
node, is joined back to move the rows one level down. Nothing reaches the driver but the number of splits. Only
nodes of more than ``NODE_ROWS`` rows are split that way: the rows of a smaller one are grouped by (tree, node), and
its task makes all cuts below, level by level, by the same rules on arrays. So the number of jobs grows with the
logarithm of rows over ``NODE_ROWS``, not with depth, trees or nodes.

Leaves hold exact curves of their in-bag rows: hazards at all their times, at risk from running sums over
positions. The mortality of a leaf is its cumulative hazard summed over all event times of the training
rows: each hazard counts once for every event time from its own on, so it is one number a leaf.

Rows that are on the same side of all thresholds (or have the same values, where a feature has many thresholds) have the
same leaves. Leaves are searched once for each such set of rows; mortalities and out-of-bag risks are then made of blocks of
``BLOCK`` rows that meet the leaves of their sets, all trees at once, and what the trees need of a block is sent packed.
A task that sums up leaves holds about ``LEAF_ROWS`` in-bag rows of a tree, fewer if they fall into the same leaf and time.

The search of leaves moves (row, tree) pairs down the split tables: blocks of ``NODE_ROWS`` pairs of a tree meet its splits in a
cogroup; of trees of more splits than that, the upper levels are equi-joins on (tree, node), and what meets is a
subtree. Leaf values are averaged over trees. A missing feature value goes left; training rows with missing values are left out.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardflow.operators import bags
from hazardflow.operators.concordance import concordance_by
from hazardflow.operators.positions import running, with_position
from hazardflow.operators.scan import value_edges
from hazardflow.session import cut_lineage, ship_package

MAX_DEPTH = 60
BINS, TIME_BINS = 32, 16
UNITS = 1e9
#: Rows of a node that one task can split on; pairs of a block and splits of a subtree when scoring.
NODE_ROWS = 1 << 16
#: Cells (times features) a tree may grow from in one task; rows of a block that is counted for all trees at once.
TREE_CELLS = 1 << 23
BLOCK = 1 << 16
#: Sets of rows whose leaves meet a block; in-bag rows of a tree that one task sums up by leaf.
SETS, LEAF_ROWS = 1 << 14, 1 << 20
#: Features of more thresholds tell sets of rows by their values.
MOST_THRESHOLDS = 128
SPLITS = "tree int, node long, feature int, bin int, threshold double, statistic double, n_left long, n_right long"


def draw(label: str, *parts: Column) -> Column:
    """48 bits of an MD5 over ``label:part:part..``, a whole number in a double; any SQL engine can repeat it."""
    text = F.concat_ws(":", F.lit(label), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double")


def poisson_steps() -> list[int]:
    """48-bit draws from which on a Poisson(1) weight is at least 1, 2, ..: the distribution function in 2**-48."""
    steps, total, k = [], 0.0, 0
    while len(steps) < 12:
        total += math.exp(-1) / math.factorial(k)
        steps.append(math.floor(total * (1 << 48)))
        k += 1
    return steps


def bootstrap_weight(seed: int, tree: Column, row: Column) -> Column:
    """Poisson(1) weight of a row in a tree."""
    once = F.array(draw(f"bag:{seed}", tree, row))  # bound to a name, so that it is drawn once a row
    steps = [float(x) for x in poisson_steps()]
    return F.get(F.transform(once, lambda u: sum(((u >= F.lit(x)).cast("int") for x in steps[1:]), (u >= F.lit(steps[0])).cast("int"))), F.lit(0))


def tail_of(row: Column) -> Column:
    """The end of the text whose hash is a row's draw, for ``bags.weights``."""
    return F.concat_ws(":", F.lit(""), row.cast("string"))


def node_features(seed: int, tree: Column, node: Column, p: int, m: int) -> Column:
    """The ``m`` features (of ``p``) that a node may split on: those of least draw."""
    drawn = F.array_sort(F.array(*[F.struct(draw(f"feature:{seed}", tree, node, F.lit(f)).alias("u"), F.lit(f).alias("f"))
                                   for f in range(p)]))
    return F.transform(F.slice(drawn, 1, m), lambda s: s["f"])


def bin_of(x: Column, edges: Sequence[float]) -> Column:
    """Number of edges below ``x``: a cut at bin b means ``x <= edges[b]``."""
    return sum(((x > F.lit(float(e))).cast("int") for e in edges), F.lit(0))


@dataclass
class GrowthSettings:
    n_trees: int = 100
    min_split: int = 10
    min_leaf: int = 5
    max_depth: int = MAX_DEPTH
    max_features: int | None = None
    seed: int = 42

    def tried(self, p: int) -> int:
        return self.max_features or max(1, math.isqrt(p))


def best_logrank_splits(state: DataFrame, n_times: int, s: GrowthSettings) -> DataFrame:
    """(tree, node, feature, bin, statistic, n_left, n_right): the best cut of each node of ``state`` that has one.

    ``state``: (tree, node, feats, bins, w, event, tbin) rows in the bag. The statistic is the log-rank
    chi-square of the two sides over the time bins; ties go to the lesser feature, then the lesser bin.
    """
    each = state.select("tree", "node", "w", "event", "tbin", F.explode("feats").alias("feature"), "bins").withColumn(
        "bin", F.get("bins", F.col("feature")))
    times = range(n_times)
    cells = each.groupBy("tree", "node", "feature", "bin").agg(
        F.expr("count(*) AS c"), F.expr("sum(w * event) AS e"),
        *[F.expr(f"sum(IF(tbin >= {t}, w, 0)) AS r{t}") for t in times],
        *[F.expr(f"sum(IF(tbin = {t}, w * event, 0)) AS d{t}") for t in times])
    whole = "OVER (PARTITION BY tree, node, feature)"
    upto = "OVER (PARTITION BY tree, node, feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    sides = cells.selectExpr("tree", "node", "feature", "bin", f"sum(c) {whole} AS c", f"sum(c) {upto} AS cl", f"sum(e) {upto} AS el",
                             *[f"sum({x}{t}) {over} AS {x}{out}{t}" for x, out, over in (("r", "a", whole), ("d", "a", whole), ("r", "l", upto))
                               for t in times])
    cuts = sides.where((F.col("c") >= s.min_split) & (F.col("cl") >= s.min_leaf) & (F.col("c") - F.col("cl") >= s.min_leaf))
    # at risk, deaths and at risk on the left, by time bin
    by_time = ", ".join(f"named_struct('r', double(ra{t}), 'd', double(da{t}), 'l', double(rl{t}))" for t in times)
    packed = cuts.selectExpr("tree", "node", "feature", "bin", "c", "cl", "el", f"array({by_time}) AS x")
    scored = packed.selectExpr(
        "tree", "node", "feature", "bin", "c", "cl",
        "el - aggregate(x, 0D, (s, t) -> s + IF(t.r > 0, t.d * t.l / t.r, 0D)) AS u",
        "aggregate(x, 0D, (s, t) -> s + IF(t.r > 1, t.d * (t.r - t.d) / (t.r - 1) * (t.l / t.r) * (1 - t.l / t.r), 0D)) AS v"
    ).where(F.col("v") > 1e-12)
    stat = F.round(F.col("u") * F.col("u") / F.col("v"), 9)
    best = scored.withColumn("statistic", stat).where("statistic > 0").groupBy("tree", "node").agg(
        F.max(F.struct("statistic", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "cl", "c")).alias("m"))
    return best.select("tree", "node", (-F.col("m.f")).alias("feature"), (-F.col("m.b")).alias("bin"), F.col("m.statistic").alias("statistic"),
                       F.col("m.cl").alias("n_left"), (F.col("m.c") - F.col("m.cl")).alias("n_right"))


def roots(spark: SparkSession, p: int, s: GrowthSettings) -> DataFrame:
    """(tree, feats): one row a tree."""
    tree = F.col("id").cast("int")
    return spark.range(s.n_trees).select(tree.alias("tree"), node_features(s.seed, tree, F.lit(1), p, s.tried(p)).alias("feats"))


def first_level(binned: DataFrame, p: int, s: GrowthSettings) -> DataFrame:
    """In-bag rows of all trees at their roots, from (id, event, tbin, bins) rows."""
    trees = F.broadcast(roots(binned.sparkSession, p, s))  # n_trees rows
    rows = binned.select("*", F.explode(F.sequence(F.lit(0), F.lit(s.n_trees - 1))).alias("tree"))
    rows = rows.withColumn("w", bootstrap_weight(s.seed, F.col("tree"), F.col("id"))).where("w > 0")
    return rows.join(trees, "tree").select("tree", F.lit(1).cast("long").alias("node"), "feats", "id", "w", "event", "tbin", "bins")


def moved(state: DataFrame, splits: DataFrame, p: int, s: GrowthSettings) -> DataFrame:
    """Rows of split nodes at their child, unless it is too small to be split again."""
    child = lambda right: node_features(s.seed, F.col("tree"), F.col("node") * 2 + right, p, s.tried(p))
    table = splits.select("tree", "node", "feature", "bin", "n_left", "n_right", child(0).alias("lf"), child(1).alias("rf"))
    rows = state.drop("feats").join(table, ["tree", "node"])
    right = F.get("bins", F.col("feature")) > F.col("bin")
    size = F.when(right, F.col("n_right")).otherwise(F.col("n_left"))
    return rows.where(size >= max(s.min_split, 2 * s.min_leaf)).select(
        "tree", (F.col("node") * 2 + right.cast("long")).alias("node"), F.when(right, F.col("rf")).otherwise(F.col("lf")).alias("feats"),
        "id", "w", "event", "tbin", "bins", size.alias("size"))


def with_threshold(splits: DataFrame, edges: Sequence[Sequence[float]]) -> DataFrame:
    """Adds the value of each cut: the edge of its feature and bin."""
    flat = F.array(*[F.array(*[F.lit(float(v)) for v in e]).cast("array<double>") for e in edges])
    return splits.withColumn("threshold", F.get(F.get(flat, F.col("feature")), F.col("bin")))


def _tried(seed: int, tree: int, node: int, p: int, m: int) -> list[int]:
    """``node_features`` of one node."""
    drawn = sorted((int(hashlib.md5(f"feature:{seed}:{tree}:{node}:{f}".encode()).hexdigest()[:12], 16), f) for f in range(p))
    return [f for _, f in drawn[:m]]


def _best_cuts(slot: np.ndarray, tried: np.ndarray, bins: np.ndarray, c: np.ndarray, w: np.ndarray, event: np.ndarray, tbin: np.ndarray,
               n_bins: int, n_times: int, s: GrowthSettings) -> list[tuple]:
    """(node, statistic, feature, bin, n_left, n) of the best cut of each node that has one, as ``best_logrank_splits``.

    ``slot`` tells the node of each cell of ``c`` rows of weight ``w``, ``tried`` (nodes x m) the features of the nodes.
    """
    k, found = len(tried), []
    for feature in tried.T:
        cell = slot * n_bins + bins[np.arange(len(slot)), feature[slot]]
        shape = (k, n_bins, n_times)
        count = np.bincount(cell, weights=c, minlength=k * n_bins).astype(np.int64).reshape(k, n_bins)
        key = cell * n_times + tbin
        weights, deaths = (np.bincount(key, weights=x, minlength=k * n_bins * n_times).reshape(shape) for x in (w, w * event))
        at_risk = weights[:, :, ::-1].cumsum(axis=2)[:, :, ::-1]
        left = count.cumsum(axis=1)
        whole = left[:, -1:]
        node, cut = np.nonzero((count > 0) & (whole >= s.min_split) & (left >= s.min_leaf) & (whole - left >= s.min_leaf))
        r, d, l = at_risk.sum(axis=1)[node], deaths.sum(axis=1)[node], at_risk.cumsum(axis=1)[node, cut]
        e, v = np.zeros(len(node)), np.zeros(len(node))
        with np.errstate(divide="ignore", invalid="ignore"):
            for t in range(n_times):
                rt, dt, lt = r[:, t], d[:, t], l[:, t]
                e += np.where(rt > 0, dt * lt / rt, 0.0)
                v += np.where(rt > 1, dt * (rt - dt) / (rt - 1) * (lt / rt) * (1 - lt / rt), 0.0)
            u = deaths.sum(axis=2).cumsum(axis=1)[node, cut] - e
            raw = np.where(v > 1e-12, u * u / v, -1.0)
        found.append((node, raw, feature[node], cut, left[node, cut], whole[node, 0]))
    node, raw, feature, cut, n_left, n = (np.concatenate(x) for x in zip(*found))
    most = np.full(k, -np.inf)
    np.maximum.at(most, node, raw)
    best: dict[int, tuple] = {}
    for i in np.flatnonzero((raw >= most[node] - 2e-9) & (raw > 0)):  # rounding may make ties of these
        stat = float(Decimal(repr(float(raw[i]))).quantize(Decimal("1e-9"), ROUND_HALF_UP))
        rank = (-stat, int(feature[i]), int(cut[i]))
        if stat > 0 and (int(node[i]) not in best or rank < best[int(node[i])][0]):
            best[int(node[i])] = rank, (int(node[i]), stat, int(feature[i]), int(cut[i]), int(n_left[i]), int(n[i]))
    return [x for _, x in best.values()]


def _grow_node(edges: Sequence[Sequence[float]], n_times: int, s: GrowthSettings):
    """All splits below one node from its cells (bins, rows, weight, event, time bin)."""
    p, n_bins = len(edges), max((len(e) for e in edges), default=0) + 1
    deepest, least = min(s.max_depth, MAX_DEPTH), max(s.min_split, 2 * s.min_leaf)

    def run(tree: int, node: int, bins: np.ndarray, c: np.ndarray, w: np.ndarray, event: np.ndarray, tbin: np.ndarray) -> pa.Table:
        nodes, out = [node], []
        slot = np.zeros(len(w), np.int64)
        while nodes and nodes[0].bit_length() <= deepest:
            following, moved_to = [], np.full(len(slot), -1)
            step = max(1, (1 << 18) // (n_bins * n_times))
            order = np.argsort(slot, kind="stable")
            first = np.searchsorted(slot[order], np.arange(len(nodes) + 1))
            for a in range(0, len(nodes), step):
                some, here = nodes[a: a + step], order[first[a]: first[min(a + step, len(nodes))]]
                tried = np.array([_tried(s.seed, tree, x, p, s.tried(p)) for x in some])
                child = np.full((len(some), 2), -1)
                feature, cut = np.zeros(len(some), np.int64), np.zeros(len(some), np.int64)
                for i, stat, f, b, n_left, n in _best_cuts(slot[here] - a, tried, bins[here], c[here], w[here], event[here], tbin[here], n_bins, n_times, s):
                    feature[i], cut[i] = f, b
                    out.append((tree, some[i], f, b, float(edges[f][b]) if b < len(edges[f]) else None, stat, n_left, n - n_left))
                    for side, size in enumerate((n_left, n - n_left)):
                        if size >= least:
                            child[i, side] = len(following)
                            following.append(2 * some[i] + side)
                at = slot[here] - a
                moved_to[here] = child[at, (bins[here, feature[at]] > cut[at]).astype(np.int64)]
            stay = moved_to >= 0
            bins, c, w, event, tbin, slot, nodes = bins[stay], c[stay], w[stay], event[stay], tbin[stay], moved_to[stay], following
        kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
        names = [x.split() for x in SPLITS.split(", ")]
        return pa.table({x: pa.array([r[i] for r in out], kinds[kind]) for i, (x, kind) in enumerate(names)})
    return run


def _grow_below(edges: Sequence[Sequence[float]], n_times: int, s: GrowthSettings):
    """All splits below one node from its rows, which are ``NODE_ROWS`` or fewer."""
    grown = _grow_node(edges, n_times, s)

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        bins = rows.column("bins").combine_chunks().flatten().to_numpy().reshape(-1, len(edges))
        w, event, tbin = (rows.column(x).to_numpy() for x in ("w", "event", "tbin"))
        return grown(key[0].as_py(), key[1].as_py(), bins, np.ones(len(w)), w, event, tbin)
    return run


def _joined(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The rows of a partition in tables of ``size``, the last one smaller."""
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, size - n)
            held.append(part)
            n, batch = n + part.num_rows, batch.slice(part.num_rows)
            if n == size:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _bytes(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _cells_by_tree(s: GrowthSettings):
    """(tree, cells, c, w), packed: cells (bins, time bin, event) of the in-bag rows of a block, their rows and weights."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _joined(batches, BLOCK):
            key = np.concatenate([_matrix(rows.column("bins"), rows.num_rows), rows.column("tbin").to_numpy()[:, None],
                                  rows.column("event").to_numpy()[:, None]], axis=1).astype(np.int32)
            by = np.lexsort(key.T)
            first = np.concatenate([[True], (key[by][1:] != key[by][:-1]).any(axis=1)])
            cells, cell = key[by][first], np.empty(len(by), np.int64)
            cell[by] = np.cumsum(first) - 1
            drawn = bags.weights(s.seed, s.n_trees, rows.column("tail"), poisson_steps())
            out = []
            for tree, w in enumerate(drawn):
                c = np.bincount(cell, weights=w > 0, minlength=len(cells)).astype(np.int32)
                some = np.flatnonzero(c)
                weight = np.bincount(cell, weights=w, minlength=len(cells)).astype(np.int32)
                out.append((tree, cells[some].tobytes(), c[some].tobytes(), weight[some].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), (pa.int32(), *[pa.binary()] * 3))], names=["tree", "cells", "c", "w"])
    return run


def _grow_tree(edges: Sequence[Sequence[float]], n_times: int, s: GrowthSettings):
    """All splits of a tree from the cells of all blocks."""
    grown, p = _grow_node(edges, n_times, s), len(edges)

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        cells = _bytes(rows.column("cells"), np.int32).reshape(-1, p + 2)
        c, w = (_bytes(rows.column(x), np.int32).astype(np.float64) for x in ("c", "w"))
        return grown(key[0].as_py(), 1, cells[:, :p], c, w, cells[:, p + 1], cells[:, p].astype(np.int64))
    return run


def _grow_from_cells(binned: DataFrame, n: int, edges: Sequence[Sequence[float]], n_times: int, s: GrowthSettings) -> DataFrame:
    """The splits of all trees, each grown in one task."""
    parts = max(binned.sparkSession.sparkContext.defaultParallelism, -(-n // BLOCK))
    order = [*[F.get("bins", F.lit(f)) for f in range(len(edges))], F.col("tbin"), F.col("event"), F.col("tail")]
    rows = binned.select("bins", "tbin", "event", tail_of(F.col("id")).alias("tail"))
    near = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)  # rows of a cell: in one block, if they fit
    packed = near.mapInArrow(_cells_by_tree(s), "tree int, cells binary, c binary, w binary")
    return packed.groupBy("tree").applyInArrow(_grow_tree(edges, n_times, s), SPLITS)


def _few_cells(binned: DataFrame, n: int, edges: Sequence[Sequence[float]], n_times: int, limit: int) -> bool:
    bound = 2 * n_times
    for e in edges:
        bound *= len(e) + 1
    return min(n, bound) <= limit or binned.select("bins", "tbin", "event").distinct().count() <= limit


def grow(binned: DataFrame, edges: Sequence[Sequence[float]], n_times: int, s: GrowthSettings, node_rows: int | None = None) -> list[DataFrame]:
    """RSF-1: split tables (``SPLITS``), one a level, from (id, event, tbin, bins) rows."""
    ship_package(binned.sparkSession)
    p, limit, names = len(edges), node_rows or NODE_ROWS, [c.split()[0] for c in SPLITS.split(", ")]
    n = binned.count()
    if _few_cells(binned, n, edges, n_times, node_rows or max(NODE_ROWS, TREE_CELLS // max(1, p))):
        return _by_level([], _grow_from_cells(binned, n, edges, n_times, s))
    state = first_level(binned, p, s).withColumn("size", F.lit(n))
    upper: list[DataFrame] = []
    below: list[DataFrame] = []
    while True:
        small = state.where(F.col("size") <= limit).select("tree", "node", "w", "event", "tbin", "bins")
        below.append(small.groupBy("tree", "node").applyInArrow(_grow_below(edges, n_times, s), SPLITS))
        if n <= limit or len(upper) == min(s.max_depth, MAX_DEPTH):
            break
        large = state.where(F.col("size") > limit)
        found = cut_lineage(with_threshold(best_logrank_splits(large, n_times, s), edges).select(*names))
        if found.isEmpty():
            break
        upper.append(found)
        state = cut_lineage(moved(large.drop("size"), found, p, s))
    rest = below[0]
    for part in below[1:]:
        rest = rest.unionByName(part)
    return _by_level(upper, rest)


def _by_level(upper: Sequence[DataFrame], rest: DataFrame) -> list[DataFrame]:
    names, level = [c.split()[0] for c in SPLITS.split(", ")], F.length(F.bin("node")) - 1
    rest = cut_lineage(rest.withColumn("_level", level))
    deepest = rest.agg(F.max("_level")).first()[0]
    levels = []
    for i in range(max(len(upper), -1 if deepest is None else deepest + 1)):
        here = rest.where(F.col("_level") == i).select(*names)
        levels.append(upper[i].unionByName(here) if i < len(upper) else here)
    return levels


def _descend(schema: Sequence[str]):
    """Rows of a block with their leaves, by the splits of their (sub)tree."""
    def run(rows: pa.Table, splits: pa.Table) -> pa.Table:
        node, ids = rows.column("node").to_numpy().copy(), splits.column("_n").to_numpy()
        if len(node) and len(ids):
            by = np.argsort(ids)
            ids, feature, threshold = ids[by], splits.column("feature").to_numpy()[by], splits.column("threshold").to_numpy()[by]
            flat = rows.column("x").combine_chunks().flatten()
            x = pc.fill_null(flat, -math.inf).to_numpy(zero_copy_only=False).reshape(len(node), -1)  # missing: left
            live = np.arange(len(node))
            while len(live):
                at = np.minimum(np.searchsorted(ids, node[live]), len(ids) - 1)
                hit = ids[at] == node[live]
                live, at = live[hit], at[hit]
                value = x[live, feature[at]]
                node[live] = 2 * node[live] + ((value > threshold[at]) | np.isnan(value))  # NaN is above all numbers
        return pa.table({c: pa.array(node) if c == "node" else rows.column(c) for c in schema})
    return run


def leaf_of(rows: DataFrame, levels: Sequence[DataFrame], limit: int | None = None) -> DataFrame:
    """``rows`` (tree, x array, ..) with ``node``, the leaf of each row in its tree."""
    limit = limit or NODE_ROWS
    out = rows.withColumn("node", F.lit(1).cast("long"))
    if not levels:
        return out
    ship_package(rows.sparkSession)
    splits, tree = None, rows.schema["tree"].dataType
    for i, level in enumerate(levels):
        part = level.select(F.col("tree").cast(tree).alias("_t"), F.col("node").cast("long").alias("_n"), F.col("feature").cast("int").alias("feature"),
                            F.col("threshold").cast("double").alias("threshold"), F.lit(i).alias("_level"))
        splits = part if splits is None else splits.unionByName(part)
    most = splits.groupBy("_t").count().agg(F.max("count")).first()[0] or 0
    pairs = rows.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    top = min(len(levels), max(0, math.ceil(math.log2(max(most, 1) / limit))))
    for level in levels[:top]:
        at = level.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "feature", "threshold")
        right = F.coalesce(F.get("x", F.col("feature")) > F.col("threshold"), F.lit(False))
        out = out.join(at, (F.col("tree") == F.col("_t")) & (F.col("node") == F.col("_n")), "left").withColumn(
            "node", F.when(F.col("_n").isNull(), F.col("node")).otherwise(F.col("node") * 2 + right.cast("long"))
        ).drop("_t", "_n", "feature", "threshold")
    blocks = max(1, -(-pairs // (limit << top)))
    dealt = out.withColumn("_sub", F.col("node")).withColumn("_blk", F.pmod(F.xxhash64(*rows.columns), F.lit(blocks)))
    lower = splits.where(F.col("_level") >= top).select(
        "_t", F.expr(f"shiftright(_n, _level - {top})").alias("_s"), "_n", "feature", "threshold",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("_b"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    return dealt.groupBy("tree", "_sub", "_blk").cogroup(lower.groupBy("_t", "_s", "_b")).applyInArrow(_descend(out.columns), schema)


def thresholds_of(levels: Sequence[DataFrame], p: int) -> list[list[float] | None]:
    """The thresholds of each feature, or None for a feature of more than ``MOST_THRESHOLDS``."""
    if not levels:
        return [[] for _ in range(p)]
    every = levels[0].select("feature", "threshold")
    for level in levels[1:]:
        every = every.unionByName(level.select("feature", "threshold"))
    some = F.slice(F.sort_array(F.collect_set("threshold")), 1, MOST_THRESHOLDS + 1)
    at = {r["feature"]: r["t"] for r in every.where("threshold IS NOT NULL").select(F.col("feature").cast("int").alias("feature"), F.col("threshold").cast("double").alias(
        "threshold")).distinct().groupBy("feature").agg(some.alias("t")).collect()}  # at most 129 numbers a feature
    return [None if len(at.get(f, [])) > MOST_THRESHOLDS else at.get(f, []) for f in range(p)]


def with_sets(rows: DataFrame, thresholds: Sequence[Sequence[float] | None]) -> DataFrame:
    """``rows`` (x, ..) with ``set``: bytes that rows share only if they have the same leaf in all trees."""
    steps = [None if t is None else np.array(t, np.float64) for t in thresholds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = pc.fill_null(batch.column("x").flatten(), -math.inf).to_numpy(zero_copy_only=False)  # missing: left
            x = flat.reshape(batch.num_rows, len(steps))
            parts = [np.zeros((batch.num_rows, 0), np.uint8)]
            for f, t in enumerate(steps):  # NaN is above all numbers
                code = np.ascontiguousarray(x[:, f]) if t is None else np.searchsorted(t, x[:, f]).astype(np.uint8)
                parts.append(code.view(np.uint8).reshape(batch.num_rows, -1))
            keys = np.concatenate(parts, axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([k.tobytes() for k in keys], pa.binary())], names=[*batch.schema.names, "set"])

    ship_package(rows.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return cut_lineage(rows.mapInArrow(run, schema + ", `set` binary"))


def sets_of(rows: DataFrame) -> DataFrame:
    """(set, x, n): one row a set, with a row's values and the number of rows."""
    return cut_lineage(rows.groupBy("set").agg(F.any_value("x").alias("x"), F.count(F.lit(1)).alias("n")))


def leaves_of_sets(sets: DataFrame, levels: Sequence[DataFrame], n_trees: int) -> DataFrame:
    """(set, n, nodes): the leaves of each set in the order of the trees."""
    pairs = sets.select("set", "x", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree"))
    at = leaf_of(pairs, levels).groupBy("set").agg(F.sort_array(F.collect_list(F.struct("tree", "node"))).alias("at"))  # one a tree
    return cut_lineage(sets.select("set", "n").join(at, "set").select("set", "n", F.col("at.node").alias("nodes")))


def mortality_of_sets(leaves: DataFrame, mortality: DataFrame) -> DataFrame:
    """(set, values): the leaf mortalities of each set in the order of the trees."""
    each = leaves.select("set", F.posexplode("nodes").alias("tree", "node")).join(mortality, ["tree", "node"], "left")
    by_tree = F.sort_array(F.collect_list(F.struct("tree", "mortality")))
    return each.groupBy("set").agg(by_tree.alias("at")).select("set", F.col("at.mortality").alias("values"))


def _meet(rows: DataFrame, sets: DataFrame, run, schema: str) -> DataFrame:
    """``run`` on blocks of ``rows`` (set, ..) with the rows of ``sets`` (set, n, ..) that they need."""
    group = F.pmod(F.xxhash64("set"), F.lit(max(1, -(-sets.count() // SETS))))
    sizes = [(r["g"], -(-r["n"] // BLOCK)) for r in sets.groupBy(group.alias("g")).agg(F.sum("n").alias("n")).collect()]  # one row for SETS sets
    blocks = F.broadcast(rows.sparkSession.createDataFrame(sizes, "_g long, _blocks long"))
    tasks = min(2 * sum(b for _, b in sizes) + 1, 10_000)  # blocks are dealt to tasks by a hash
    dealt = rows.withColumn("_g", group).join(blocks, "_g").withColumn("_b", F.pmod(F.xxhash64(*rows.columns), "_blocks")).drop("_blocks")
    own = sets.select(*[F.col(c).alias(c) for c in sets.columns])  # columns of its own, where it is made of ``rows``
    copies = own.withColumn("_g", group).join(blocks, "_g").withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))).drop("_blocks")
    left, right = (t.repartition(tasks, "_g", "_b") for t in (dealt, copies))
    return left.groupBy("_g", "_b").cogroup(right.groupBy("_g", "_b")).applyInArrow(run, schema)


def _in_set(rows: pa.Table, sets: pa.Table) -> np.ndarray:
    """The place of each row's set."""
    return pc.index_in(rows.column("set"), value_set=sets.column("set").combine_chunks()).to_numpy().astype(np.int64)


def _to_leaves(s: GrowthSettings, parts: int):
    """(tree, part, leaves, leaf, key, we), packed: in-bag rows of a block by the place of their leaf, time and weight with event."""
    def run(rows: pa.Table, sets: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows:
            at, nodes = _in_set(rows, sets), _matrix(sets.column("nodes"), sets.num_rows)
            key, event = rows.column("key").to_numpy().astype(np.int64), rows.column("event").to_numpy()
            for tree, w in enumerate(bags.weights(s.seed, s.n_trees, rows.column("tail"), poisson_steps())):
                leaves, leaf = np.unique(nodes[:, tree], return_inverse=True)
                some = np.flatnonzero(w)
                place, when, heavy = leaf[at[some]], key[some], (w[some] << 1 | event[some]).astype(np.uint8)
                for part in range(parts):
                    mine = np.flatnonzero(leaves % parts == part) if parts > 1 else np.arange(len(leaves))
                    code = np.full(len(leaves), -1, np.int64)
                    code[mine] = np.arange(len(mine))
                    here = np.flatnonzero(code[place] >= 0) if parts > 1 else slice(None)
                    if len(place[here]):
                        out.append((tree, part, leaves[mine].tobytes(), code[place[here]].astype(np.uint16).tobytes(),
                                    when[here].astype(np.int32).tobytes(), heavy[here].tobytes()))
        kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 4)
        return pa.table({x: pa.array([r[i] for r in out], kinds[i]) for i, x in enumerate(("tree", "part", "leaves", "leaf", "key", "we"))})
    return run


def _mortality_of(n_keys: int):
    """(tree, node, mortality) of the leaves of a part of a tree; keys number the event times from 1."""
    def summed(code, n, d):
        by = np.argsort(code, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], code[by][1:] != code[by][:-1]])[: len(by)])
        return code[by][first], np.add.reduceat(n[by], first), np.add.reduceat(d[by], first)

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        every = np.unique(_bytes(rows.column("leaves"), np.int64))
        columns = zip(*(rows.column(x).to_pylist() for x in ("leaves", "leaf", "key", "we")))
        held, new, waiting = [np.zeros(0, np.int64)] * 3, [], 0
        for leaves, leaf, when, we in columns:
            place = np.searchsorted(every, np.frombuffer(leaves, np.int64))[np.frombuffer(leaf, np.uint16)]
            heavy = np.frombuffer(we, np.uint8).astype(np.int64)
            new.append((place * (n_keys + 1) + np.frombuffer(when, np.int32), heavy >> 1, (heavy >> 1) * (heavy & 1)))
            waiting += len(place)
            if waiting > LEAF_ROWS:
                held, new, waiting = summed(*(np.concatenate([a, *b]) for a, b in zip(held, zip(*new)))), [], 0
        code, n, d = summed(*(np.concatenate([a, *b]) for a, b in zip(held, zip(*new)))) if new else held
        leaf, when = code // (n_keys + 1), code % (n_keys + 1)
        upto = np.cumsum(n)
        last = upto[np.searchsorted(leaf, leaf, side="right") - 1]
        parts = d / (last - upto + n) * (n_keys + 1 - when)  # once for each event time from this one on
        total = np.bincount(leaf, weights=np.where(d > 0, parts, 0.0), minlength=len(every))
        # whole units of 1e-9, so that rows of the same leaves have the same sum in any order
        return pa.table({"tree": pa.array(np.full(len(every), key[0].as_py()), pa.int32()), "node": pa.array(every),
                         "mortality": pa.array(np.floor(total * UNITS + 0.5).astype(np.int64))})
    return run


def _out_of_bag(s: GrowthSettings, schema: Sequence[str]):
    """Rows with the sum and number of the mortalities in trees whose bag they aren't in; rows in all bags are left out."""
    def run(rows: pa.Table, sets: pa.Table) -> pa.Table:
        n = rows.num_rows
        total, known, outside = (np.zeros(n, np.int64) for _ in range(3))
        if n:
            at, flat = _in_set(rows, sets), sets.column("values").combine_chunks().flatten()
            has = flat.is_valid().to_numpy(zero_copy_only=False).reshape(sets.num_rows, -1)
            values = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).reshape(sets.num_rows, -1)
            for tree, w in enumerate(bags.weights(s.seed, s.n_trees, rows.column("tail"), poisson_steps())):
                out = w == 0
                total += np.where(out, values[at, tree], 0)
                known += out & has[at, tree]
                outside += out
        made = {"total": pa.array(total), "known": pa.array(known)}
        return pa.table({c: made[c] if c in made else rows.column(c) for c in schema}).filter(pa.array(outside > 0))
    return run


def mean_mortality() -> Column:
    """Mean of the leaf mortalities of a group's rows, from their sums and numbers; leaves without in-bag rows don't count."""
    return (F.sum("total").cast("double") / F.lit(UNITS) / F.when(F.sum("known") > 0, F.sum("known"))).alias("risk")


@dataclass
class SurvivalForest:
    """Fitted trees: split tables by level, leaf hazards and leaf mortality."""

    features: list[str]
    levels: list[DataFrame]
    settings: GrowthSettings
    train: DataFrame = field(repr=False)
    mortality: DataFrame = field(repr=False)
    thresholds: list[list[float] | None] = field(repr=False)
    known: DataFrame = field(repr=False)
    first_time: float = 0.0
    last_time: float = 0.0
    id_col: str = "subject_id"
    time_col: str = "duration"
    event_col: str = "event"

    @functools.cached_property
    def hazards(self) -> DataFrame:
        """(tree, node, time, h, ends) of all leaves' times."""
        return leaf_hazards(self.train, self.levels, self.features, self.settings, id_col=self.id_col, time_col=self.time_col, event_col=self.event_col)

    def _pairs(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        x = F.array(*[F.col(f).cast("double") for f in self.features])
        return df.select(*keep, x.alias("x"), F.explode(F.sequence(F.lit(0), F.lit(self.settings.n_trees - 1))).alias("tree"))

    def risk(self, df: DataFrame, id_cols: Sequence[str] | None = None) -> DataFrame:
        """RSF-3: (ids, risk), the mean over trees of the mortality of a row's leaf."""
        ids = list(id_cols or [self.id_col])
        rows = self._in_sets(df, ids)
        values = self._values(rows).select(F.col("set").alias("_set"), F.aggregate("values", F.lit(0).cast("long"), lambda s, v: s + F.coalesce(v, F.lit(0))).alias("total"),
                                           F.size(F.filter("values", lambda v: v.isNotNull())).alias("known"))
        return rows.join(values, F.col("set") == F.col("_set")).groupBy(*ids).agg(mean_mortality())

    def _in_sets(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        return with_sets(df.select(*keep, F.array(*[F.col(f).cast("double") for f in self.features]).alias("x")), self.thresholds)

    def _values(self, rows: DataFrame) -> DataFrame:
        """(set, n, values): the leaf mortalities of each set in the order of the trees; leaves are searched for sets that training rows don't have."""
        sets = sets_of(rows)
        other = sets.join(self.known, "set", "left_anti")
        found = self.known
        if not other.isEmpty():
            found = found.unionByName(mortality_of_sets(leaves_of_sets(other, self.levels, self.settings.n_trees), self.mortality))
        return cut_lineage(sets.select("set", "n").join(found, "set"))

    def survival(self, df: DataFrame, times: Sequence[float], id_cols: Sequence[str] | None = None) -> DataFrame:
        """RSF-2: (ids, time, survival), the mean over trees of the leaf curves; times are clipped to the training times."""
        ids, times = list(id_cols or [self.id_col]), [float(t) for t in times]
        clipped = [min(max(t, self.first_time), self.last_time) for t in times]
        past = lambda t: F.col("time") <= F.lit(t)
        leaf = self.hazards.groupBy("tree", "node").agg(*[
            F.when(F.max(F.when(past(t) & F.col("ends"), 1)) == 1, 0.0).otherwise(
                F.exp(F.coalesce(F.sum(F.when(past(t) & ~F.col("ends"), F.log1p(-F.col("h")))), F.lit(0.0)))).alias(f"s{k}")
            for k, t in enumerate(clipped)])
        mean = leaf_of(self._pairs(df, ids), self.levels).join(leaf, ["tree", "node"], "left").groupBy(*ids).agg(
            *[F.avg(f"s{k}").alias(f"s{k}") for k in range(len(times))])
        return mean.select(*ids, F.inline(F.array(*[F.struct(F.lit(t).alias("time"), F.col(f"s{k}").alias("survival"))
                                                    for k, t in enumerate(times)])))

    def out_of_bag_risk(self, train: DataFrame) -> DataFrame:
        """(id, risk): for each training row the mean over the trees whose bag it is not in; rows in every bag have none."""
        rows = self._in_sets(train, [self.id_col])
        kind = rows.schema[self.id_col].dataType.simpleString()
        found = _meet(rows.select(F.col(self.id_col).alias("id"), "set", tail_of(F.col(self.id_col)).alias("tail")), self._values(rows),
                      _out_of_bag(self.settings, ["id", "total", "known"]), f"id {kind}, total long, known long")
        return found.groupBy(F.col("id").alias(self.id_col)).agg(mean_mortality())

    def c_index(self, df: DataFrame, risk: DataFrame | None = None) -> DataFrame:
        """RSF-4 (or RSF-5 with ``out_of_bag_risk``): the row of ``concordance_by``."""
        scored = df.select(self.id_col, self.time_col, self.event_col).join(self.risk(df) if risk is None else risk, self.id_col)
        return concordance_by(scored, time_col=self.time_col, event_col=self.event_col)


def leaf_hazards(train: DataFrame, levels: Sequence[DataFrame], features: Sequence[str], s: GrowthSettings, *, id_col: str,
                 time_col: str, event_col: str) -> DataFrame:
    """Hazards (tree, node, time, h, ends) of all leaves' times."""
    x = F.array(*[F.col(f).cast("double") for f in features])
    rows = train.select(F.col(id_col).alias("id"), F.col(time_col).cast("double").alias("time"),
                        (F.col(event_col) > 0).cast("long").alias("event"), x.alias("x"),
                        F.explode(F.sequence(F.lit(0), F.lit(s.n_trees - 1))).alias("tree"))
    rows = rows.withColumn("w", bootstrap_weight(s.seed, F.col("tree"), F.col("id")).cast("long")).where("w > 0").drop("id")
    at = leaf_of(rows, levels).groupBy("tree", "node", "time").agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("event")).alias("d"))
    upto = running(with_position(at, ["tree", "node", "time"], "p"), "p", {"upto": "n"})
    last = upto.groupBy("tree", "node").agg(F.max("upto").alias("last"))
    return cut_lineage(upto.join(last, ["tree", "node"]).withColumn("risk", F.col("last") - F.col("upto") + F.col("n")).select(
        "tree", "node", "time", (F.col("d").cast("double") / F.col("risk")).alias("h"), (F.col("d") == F.col("risk")).alias("ends")))


def leaf_mortality(train: DataFrame, levels: Sequence[DataFrame], features: Sequence[str], s: GrowthSettings,
                   thresholds: Sequence[Sequence[float] | None], *, id_col: str, time_col: str, event_col: str) -> tuple[DataFrame, DataFrame]:
    """(tree, node, mortality), the cumulative hazard of a leaf summed over all event times of ``train``, and (set, values), the same by set of rows."""
    rows = with_sets(train.select(
        tail_of(F.col(id_col)).alias("tail"), F.col(time_col).cast("double").alias("time"), F.coalesce((F.col(event_col) > 0).cast("int"), F.lit(0)).alias("event"),
        F.array(*[F.col(f).cast("double") for f in features]).alias("x")), thresholds)
    # a time counts as the last event time up to it: hazards are 0 between event times
    times = with_position(rows.groupBy("time").agg(F.max("event").alias("any")), ["time"], "k")
    keyed = cut_lineage(running(times, "k", {"key": "any"}).select(F.col("time").alias("_time"), F.col("key").cast("int").alias("key")))
    n_keys = keyed.agg(F.max("key")).first()[0] or 0
    sets = leaves_of_sets(sets_of(rows), levels, s.n_trees)
    n = sets.agg(F.sum("n")).first()[0] or 0
    there = rows.join(keyed, F.col("time").eqNullSafe(F.col("_time"))).select("tail", "set", "event", "key")
    sent = _meet(there, sets, _to_leaves(s, max(1, -(-n * 2 // (3 * LEAF_ROWS)))), "tree int, part int, leaves binary, leaf binary, key binary, we binary")
    mortality = cut_lineage(sent.groupBy("tree", "part").applyInArrow(_mortality_of(n_keys), "tree int, node long, mortality long"))
    return mortality, cut_lineage(mortality_of_sets(sets, mortality))


def forest_from_splits(train: DataFrame, levels: Sequence[DataFrame], features: Sequence[str], s: GrowthSettings, *,
                       id_col: str = "subject_id", time_col: str = "duration", event_col: str = "event") -> SurvivalForest:
    """Leaf tables for given split tables (tree, node, feature, threshold), one table a level."""
    thresholds = thresholds_of(levels, len(features))
    mortality, known = leaf_mortality(train, levels, features, s, thresholds, id_col=id_col, time_col=time_col, event_col=event_col)
    span = train.agg(F.min(F.col(time_col).cast("double")).alias("a"), F.max(F.col(time_col).cast("double")).alias("b")).first()
    return SurvivalForest(list(features), list(levels), s, train, mortality, thresholds, known, span["a"] or 0.0, span["b"] or 0.0,
                          id_col, time_col, event_col)


def complete_rows(df: DataFrame, features: Sequence[str], id_col: str, time_col: str, event_col: str) -> DataFrame:
    """Rows without missing values (NULL or NaN)."""
    return df.select(id_col, time_col, event_col, *features).dropna()


def fit_forest(df: DataFrame, features: Sequence[str], settings: GrowthSettings | None = None, *, bins: int = BINS,
               time_bins: int = TIME_BINS, id_col: str = "subject_id", time_col: str = "duration", event_col: str = "event") -> SurvivalForest:
    """RSF-1: grow ``n_trees`` trees on rows with unique ids and build their leaf tables."""
    s, features = settings or GrowthSettings(), list(features)
    train = cut_lineage(complete_rows(df, features, id_col, time_col, event_col))
    edges = [value_edges(train, f, bins) for f in features]
    time_edges = value_edges(train.where(F.col(event_col) > 0), time_col, time_bins)
    binned = train.select(F.col(id_col).alias("id"), (F.col(event_col) > 0).cast("int").alias("event"),
                          bin_of(F.col(time_col).cast("double"), time_edges).alias("tbin"),
                          F.array(*[bin_of(F.col(f).cast("double"), e) for f, e in zip(features, edges)]).alias("bins"))
    levels = grow(binned, edges, len(time_edges) + 1, s)
    return forest_from_splits(train, levels, features, s, id_col=id_col, time_col=time_col, event_col=event_col)
