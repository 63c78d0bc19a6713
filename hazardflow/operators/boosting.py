"""Gradient boosting with the Cox loss (GB-1..6): least-squares trees on martingale residuals.

Each round: the negative gradient of the Cox partial likelihood at the current score F is the
martingale residual ``event - exp(F) * H0(T)`` (Breslow H0 with weights exp(F)); a depth-limited regression
tree is fitted to it on a hashed subsample, and ``F += lr * tree``.

Rows are binned once and laid out once in the order of (time, id), in partitions of about ``PART_ROWS`` rows, as
that order never changes. A round is five passes over those partitions without moving a row: totals of exp(F), of
which each partition learns what is at risk behind it; totals of the hazards, of which it learns the hazard
before it; and one pass a level, which makes the residuals and adds them up by (node, feature, bin). Totals are a
row a partition; the best cut of each node (at most 2^depth rows) goes to the driver. A fitted tree is some numbers
there; scores and attributions are column expressions of them. Scores are checkpointed every few rounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardflow.functions.columns import uniform_hash
from hazardflow.operators.forest import bin_of
from hazardflow.operators.positions import with_position
from hazardflow.operators.scan import prefix_scan, value_edges
from hazardflow.session import cut_lineage, ship_package

BINS = 64
#: Rows of a partition while boosting: what a task holds.
PART_ROWS = 1 << 16


def breslow_on_score(df: DataFrame, *, score_col: str = "score", time_col: str = "duration",
                     event_col: str = "event", edges=None) -> DataFrame:
    """``H0(t) = sum_{s<=t} d(s) / sum_{T>=s} exp(F)``; one row per distinct time."""
    per = df.groupBy(F.col(time_col).cast("double").alias("time")).agg(
        F.sum(F.exp(F.col(score_col))).alias("ph"),
        F.sum((F.col(event_col) > 0).cast("long")).alias("d"))
    rs = prefix_scan(per, [], "time", {"risk": "ph"}, descending=True, edges=edges)
    hz = rs.withColumn("h", F.col("d").cast("double") / F.col("risk"))
    return prefix_scan(hz, [], "time", {"cum_hazard": "h"}, edges=edges).select("time", "cum_hazard")


def martingale_residuals(df: DataFrame, *, score_col: str = "score", time_col: str = "duration",
                         event_col: str = "event", edges=None) -> DataFrame:
    """GB-2: adds ``residual = event - exp(F) * H0(T)``.

    Every subject's own time is a curve time, so the lookup is an equi-join on time (the curve
    has one row per distinct time; AQE broadcasts it when it is small).
    """
    h0 = breslow_on_score(df, score_col=score_col, time_col=time_col, event_col=event_col, edges=edges)
    j = df.join(h0, F.col(time_col).cast("double") == h0["time"], "left").drop("time")
    return j.withColumn("residual", (F.col(event_col) > 0).cast("double")
                        - F.exp(F.col(score_col)) * F.coalesce(F.col("cum_hazard"), F.lit(0.0))).drop("cum_hazard")


@dataclass
class Node:
    """A node of a fitted tree: mean residual and rows in the sample; a cut if it was split."""

    value: float
    rows: int
    feature: int = -1
    bin: int = -1
    threshold: float = 0.0
    gain: float = 0.0


Tree = dict[int, Node]  # root 1; children of k are 2k (at most the threshold) and 2k + 1


def tree_case(tree: Tree, column: Callable[[int], str], leaf: Callable[[int], float], at: int = 1, cut: str = "threshold") -> str:
    """SQL of a value for each leaf; a missing feature goes left, as in training rows are complete."""
    node = tree[at]
    if node.feature < 0:
        return f"{leaf(at)!r}D"
    left, right = (tree_case(tree, column, leaf, 2 * at + side, cut) for side in (0, 1))
    edge = f"{node.threshold!r}D" if cut == "threshold" else str(node.bin)
    return f"CASE WHEN {column(node.feature)} > {edge} THEN {right} ELSE {left} END"


def path_steps(tree: Tree, leaf: int, feature: int) -> float:
    """Sum of the changes of the node mean on the way to ``leaf`` at cuts on ``feature``."""
    total, at = 0.0, leaf
    while at > 1:
        if tree[at // 2].feature == feature:
            total += tree[at].value - tree[at // 2].value
        at //= 2
    return total


@dataclass
class BoostedCox:
    features: list[str]
    learning_rate: float
    trees: list[Tree] = field(default_factory=list)

    def _sum(self, leaf_of_tree: Callable[[Tree], Callable[[int], float]]) -> str:
        column = lambda f: f"double(`{self.features[f]}`)"
        parts = [tree_case(t, column, leaf_of_tree(t)) for t in self.trees]
        return f"{self.learning_rate!r}D * ({' + '.join(parts) or '0D'})"

    @property
    def base(self) -> float:
        """Score before any cut: what attributions add to."""
        return self.learning_rate * sum(t[1].value for t in self.trees)

    def score(self, df: DataFrame, out_col: str = "score") -> DataFrame:
        """Adds the score, learning rate x sum of tree values: a column expression of the fitted numbers."""
        return df.select("*", F.expr(self._sum(lambda t: lambda k: t[k].value)).alias(out_col))

    def attributions(self, df: DataFrame, id_col: str = "subject_id") -> DataFrame:
        """GB-5: (id, base, one ``phi_<feature>`` each, score); base + sum of phi = score for every row."""
        phi = [F.expr(self._sum(lambda t, f=i: lambda k: path_steps(t, k, f))).alias(f"phi_{name}")
               for i, name in enumerate(self.features)]
        return self.score(df, "_score").select(id_col, F.lit(self.base).alias("base"), *phi, F.col("_score").alias("score"))

    def attribution_summary(self, df: DataFrame) -> DataFrame:
        """GB-5: (feature, mean_abs), the mean absolute attribution over all rows, largest first."""
        names = F.array(*[F.struct(F.lit(f).alias("feature"), F.abs(f"phi_{f}").alias("v")) for f in self.features])
        return self.attributions(df, df.columns[0]).select(F.inline(names)).groupBy("feature").agg(
            F.avg("v").alias("mean_abs")).orderBy(F.desc("mean_abs"), "feature")

    def feature_importance(self) -> list[tuple[str, float]]:
        """GB-4: share of the squared-error decrease of all trees that cuts on a feature made, descending."""
        gain = [0.0] * len(self.features)
        for t in self.trees:
            for node in t.values():
                if node.feature >= 0:
                    gain[node.feature] += node.gain
        total = sum(gain) or 1.0
        return sorted(((f, g / total) for f, g in zip(self.features, gain)), key=lambda kv: (-kv[1], kv[0]))


def best_mean_splits(rows: DataFrame, *, min_split: int = 10, min_leaf: int = 5) -> DataFrame:
    """(node, feature, bin, gain, n, s, n_left, s_left): the cut of each node that lowers the squared error most.

    ``rows``: (node, bins, residual). Ties go to the lesser feature, then the lesser bin. Nodes of fewer than
    ``min_split`` rows, and cuts with fewer than ``min_leaf`` rows on a side, are left out.
    """
    each = rows.select("node", F.posexplode("bins").alias("feature", "bin"), F.lit(1).alias("c"), F.col("residual").alias("r"))
    return _best_cuts(each, min_split, min_leaf)


def _best_cuts(counted: DataFrame, min_split: int, min_leaf: int) -> DataFrame:
    """``best_mean_splits`` of rows (node, feature, bin, c, r) that count ``c`` rows with the residual sum ``r``."""
    cells = counted.groupBy("node", "feature", "bin").agg(F.sum("c").alias("c"), F.sum("r").alias("r")).coalesce(1)  # nodes x features x bins rows, by parameters
    whole = "OVER (PARTITION BY node, feature)"
    upto = "OVER (PARTITION BY node, feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    cuts = cells.selectExpr("node", "feature", "bin", f"sum(c) {whole} AS n", f"sum(r) {whole} AS s",
                            f"sum(c) {upto} AS n_left", f"sum(r) {upto} AS s_left")
    cuts = cuts.where((F.col("n") >= min_split) & (F.col("n_left") >= min_leaf) & (F.col("n") - F.col("n_left") >= min_leaf))
    scored = cuts.withColumn("gain", F.expr(
        "round(n_left * (n - n_left) / double(n) * power(s_left / n_left - (s - s_left) / (n - n_left), 2), 12)")).where("gain > 0")
    best = scored.groupBy("node").agg(F.max(F.struct("gain", F.expr("-feature AS f"), F.expr("-bin AS b"), "n", "s", "n_left", "s_left")).alias("m"))
    return best.selectExpr("node", "-m.f AS feature", "-m.b AS bin", "m.gain AS gain", "m.n AS n", "m.s AS s",
                           "m.n_left AS n_left", "m.s_left AS s_left")


def _values(tree: Tree, bins: Sequence[np.ndarray], value: Callable[[int], float], at: int = 1) -> np.ndarray:
    """``value`` of the leaf of each row by its bins."""
    node = tree[at]
    if node.feature < 0:
        return np.full(len(bins[0]), value(at))
    return np.where(bins[node.feature] > node.bin, _values(tree, bins, value, 2 * at + 1), _values(tree, bins, value, 2 * at))


@dataclass
class _Offsets:
    """What a partition needs to know of the others: weight at risk behind it and hazard before it; if its first time
    began in an earlier one (``carried``), its weight there."""

    behind: float = 0.0
    carry: float = 0.0
    carried: bool = False
    before: float = 0.0


class _Part:
    """Rows of a partition, in the order of time, with their scores. ``runs``: first rows of the times."""

    def __init__(self, batches: Iterator[pa.RecordBatch], steps: Sequence[Tree], rate: float):
        self.table = t = pa.Table.from_batches(list(batches))
        column = lambda c: t.column(c).to_numpy()
        self.bins = [column(c) for c in t.column_names if c.startswith("b_")]
        self.part, self.pos, self.event, self.deaths, self.used = (column(c) for c in ("part", "pos", "event", "d", "used"))
        self.score = column("score") + rate * sum((_values(s, self.bins, lambda k, s=s: s[k].value) for s in steps), np.zeros(len(t)))
        self.weight = np.exp(self.score)
        self.runs = np.flatnonzero(np.concatenate([[True], self.pos[1:] != self.pos[:-1]]))

    def hazards(self, o: _Offsets) -> np.ndarray:
        """Hazard of each time here."""
        at_risk = o.behind + np.cumsum(self.weight[::-1])[::-1][self.runs]
        at_risk[0] += o.carry
        return self.deaths[self.runs] / np.maximum(at_risk, 1e-300)

    def residuals(self, o: _Offsets) -> np.ndarray:
        h = self.hazards(o)
        h[0] = 0.0 if o.carried else h[0]  # counted where its time begins
        sizes = np.diff(np.append(self.runs, len(self.pos)))
        return self.event - self.weight * np.repeat(o.before + np.cumsum(h), sizes)


def _per_part(laid: DataFrame, steps: Sequence[Tree], rate: float, work: Callable[[_Part], dict], schema: str) -> DataFrame:
    """Rows that ``work`` makes of each partition of ``laid``, without moving any."""
    steps = list(steps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if batches:
            yield pa.RecordBatch.from_pydict(work(_Part(batches, steps, rate)))
    return laid.mapInArrow(run, schema)


def _totals(p: _Part) -> dict:
    return {"part": p.part[:1], "w": [float(p.weight.sum())], "first": p.pos[:1], "last": p.pos[-1:],
            "w_last": [float(p.weight[p.runs[-1]:].sum())]}


def _offsets(laid: DataFrame, steps: Sequence[Tree], rate: float) -> dict[int, _Offsets]:
    """By partition, from a row each: two passes, as the hazards need the weights at risk."""
    rows = sorted(_per_part(laid, steps, rate, _totals, "part int, w double, first long, last long, w_last double").collect())
    out = {r["part"]: _Offsets() for r in rows}
    behind = 0.0
    for r in reversed(rows):
        out[r["part"]].behind = behind
        behind += r["w"]
    for a, b in zip(rows, rows[1:]):
        if a["last"] == b["first"]:
            out[b["part"]].carried = True
            out[b["part"]].carry = a["w_last"] + (out[a["part"]].carry if a["first"] == a["last"] else 0.0)

    def summed(p: _Part) -> dict:
        o = out[int(p.part[0])]
        return {"part": p.part[:1], "h": [float(p.hazards(o)[1 if o.carried else 0:].sum())]}

    before = 0.0
    for r in sorted(_per_part(laid, steps, rate, summed, "part int, h double").collect()) if len(rows) > 1 else []:
        out[r["part"]].before = before
        before += r["h"]
    return out


def _cells(offsets: dict[int, _Offsets], tree: Tree, wanted: Sequence[int]):
    """(node, feature, bin, c, r): rows and residual sums of the sampled rows in the nodes ``wanted`` of a growing tree."""
    def work(p: _Part) -> dict:
        residual = p.residuals(offsets[int(p.part[0])])
        node = _values(tree, p.bins, lambda k: k).astype(np.int64) if tree else np.ones(len(residual), np.int64)
        rows = np.flatnonzero(p.used & np.isin(node, wanted))
        node, residual = node[rows], residual[rows]
        parts = []
        for f, b in enumerate(p.bins):
            width = int(b.max()) + 1
            key, at = np.unique(node * width + b[rows], return_inverse=True)
            parts.append((key // width, np.full(len(key), f), key % width, np.bincount(at, minlength=len(key)),
                          np.bincount(at, weights=residual, minlength=len(key))))
        return dict(zip(("node", "feature", "bin", "c", "r"), (np.concatenate(x) for x in zip(*parts))))
    return work


def _fit_tree(laid: DataFrame, steps: Sequence[Tree], rate: float, edges: Sequence[Sequence[float]], max_depth: int, min_split: int,
              min_leaf: int) -> Tree:
    """A regression tree on the residuals of the rows ``used``: one job a level."""
    offsets = _offsets(laid, steps, rate)
    tree: Tree = {}
    wanted = [1]
    for level in range(max_depth):
        cells = _per_part(laid, steps, rate, _cells(offsets, dict(tree), wanted), "node long, feature long, bin long, c long, r double")
        found = _best_cuts(cells, min_split, min_leaf).collect()  # at most 2^level rows
        if not found:
            break
        wanted = []
        for r in found:
            k, right = r["node"], r["n"] - r["n_left"]
            tree.setdefault(k, Node(r["s"] / r["n"], r["n"]))
            tree[k].feature, tree[k].bin, tree[k].gain = r["feature"], r["bin"], r["gain"]
            tree[k].threshold = float(edges[r["feature"]][r["bin"]])
            tree[2 * k] = Node(r["s_left"] / r["n_left"], r["n_left"])
            tree[2 * k + 1] = Node((r["s"] - r["s_left"]) / right, right)
            wanted += [2 * k, 2 * k + 1]
    if not tree:
        total = _per_part(laid, steps, rate, _cells(offsets, {}, [1]), "node long, feature long, bin long, c long, r double").where(
            "feature = 0").agg(F.sum("c").alias("n"), F.sum("r").alias("s")).first()
        tree[1] = Node((total["s"] or 0.0) / max(total["n"] or 0, 1), total["n"] or 0)
    return tree


def _rescored(p: _Part) -> dict:
    return {c: pa.array(p.score) if c == "score" else p.table.column(c).combine_chunks() for c in p.table.column_names}


def fit_boosted_cox(df: DataFrame, features: Sequence[str], *, n_estimators: int = 100,
                    max_depth: int = 3, learning_rate: float = 0.1, subsample: float = 0.8, min_samples_split: int = 10,
                    min_samples_leaf: int = 5, seed: int = 42, id_col: str = "subject_id", bins: int = BINS,
                    time_col: str = "duration", event_col: str = "event", checkpoint_every: int = 10,
                    part_rows: int = PART_ROWS) -> BoostedCox:
    """GB-1: boost ``n_estimators`` trees on rows without missing values."""
    features = list(features)
    ship_package(df.sparkSession)
    base = cut_lineage(df.select(F.col(id_col).alias("id"), F.col(time_col).cast("double").alias("time"),
                                 (F.col(event_col) > 0).cast("int").alias("event"), *[F.col(f).cast("double") for f in features]).dropna())
    edges = [value_edges(base, f, bins) for f in features]
    times = with_position(base.groupBy("time").agg(F.sum("event").alias("d")), ["time"], "pos")
    binned = [bin_of(F.col(f), e).alias(f"b_{i}") for i, (f, e) in enumerate(zip(features, edges))]
    placed = base.join(times, "time").select("id", "pos", "event", "d", F.lit(0.0).alias("score"), *binned)
    laid = cut_lineage(placed.repartitionByRange(max(1, -(-base.count() // part_rows)), "pos", "id").sortWithinPartitions("pos", "id")
                       .withColumn("part", F.spark_partition_id()))
    model, start = BoostedCox(features, learning_rate), 0
    for r in range(n_estimators):
        steps = model.trees[start:]
        if len(steps) >= checkpoint_every:
            kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in laid.schema)
            laid = cut_lineage(_per_part(laid.withColumn("used", F.lit(True)), steps, learning_rate, _rescored, f"{kinds}, used boolean").drop("used"))
            start, steps = r, []
        sampled = laid.withColumn("used", uniform_hash(F.col("id"), seed * 1000 + r) < subsample)
        model.trees.append(_fit_tree(sampled, steps, learning_rate, edges, max_depth, min_samples_split, min_samples_leaf))
    return model


def hazard_at(model: BoostedCox, train: DataFrame, times: Sequence[float], *, time_col: str = "duration",
              event_col: str = "event") -> list[float]:
    """Breslow cumulative hazard of ``train`` at a few times: 0 before its first time, constant after its last."""
    h0 = breslow_on_score(model.score(train, "_score"), score_col="_score", time_col=time_col, event_col=event_col)
    at = h0.agg(*[F.max_by("cum_hazard", F.when(F.col("time") <= float(t), F.col("time"))).alias(f"h{k}") for k, t in enumerate(times)]).first()
    return [float(at[f"h{k}"] or 0.0) for k in range(len(times))]


def predict_survival(model: BoostedCox, train: DataFrame, df: DataFrame, times: Sequence[float], *,
                     id_col: str = "subject_id", time_col: str = "duration", event_col: str = "event") -> DataFrame:
    """GB-6: ``(id, time, survival)`` at a few times, ``exp(-H0(t) exp(score))`` with the Breslow hazard of ``train``."""
    hazards = hazard_at(model, train, times, time_col=time_col, event_col=event_col)
    rows = F.array(*[F.struct(F.lit(float(t)).alias("time"), F.exp(-F.lit(h) * F.exp("_score")).alias("survival"))
                     for t, h in zip(times, hazards)])
    return model.score(df, "_score").select(id_col, F.inline(rows))


def tune_and_fit(train: DataFrame, val: DataFrame, features: Sequence[str], grid: Sequence[dict], *,
                 refit_on: str = "train", **fixed) -> tuple[BoostedCox, dict, list]:
    """GB-3: fit each combination on train, keep the best validation C-index (first wins ties,
    failing combinations skipped), then refit on train (default) or train+val."""
    from hazardflow.operators.concordance import concordance

    results, best, best_c = [], None, -1.0
    for params in grid:
        try:
            m = fit_boosted_cox(train, features, **{**fixed, **params})
            c = concordance(m.score(val, "risk"), risk_col="risk")["c_index"]
        except (ArithmeticError, ValueError):  # the combination's own numbers; job failures pass on
            continue
        results.append((params, c))
        if c > best_c:
            best, best_c = params, c
    if best is None:
        raise ValueError("no parameter combination could be fitted")
    data = train if refit_on == "train" else train.unionByName(val)
    return fit_boosted_cox(data, features, **{**fixed, **best}), best, results
