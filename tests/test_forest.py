"""Forest, boosted trees and the Scorer interface: growth against brute force, attributions, one suite for all models."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hazardflow.operators import bags, boosting, cox, forest
from hazardflow.operators.importance import normalised, permutation_importance
from hazardflow.plans import scorers

SETTINGS = forest.GrowthSettings(n_trees=5, seed=3)


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(0)
    n = 160
    x = np.round(rng.normal(size=(n, 3)), 1)
    t = np.ceil(rng.exponential(np.exp(-1.5 * (x[:, 0] > 0))) * 12)
    e = (rng.uniform(size=n) < 0.75).astype(int)
    return pd.DataFrame({"subject_id": np.arange(n), "duration": t, "event": e, "a": x[:, 0], "b": x[:, 1], "c": x[:, 2]})


@pytest.fixture(scope="module")
def data(spark, frame):
    return spark.createDataFrame(frame)


@pytest.fixture(scope="module")
def fitted(data):
    return forest.fit_forest(data, ["a", "b", "c"], SETTINGS, bins=8)


def logrank(t, e, w, left):
    u = v = 0.0
    for s in np.unique(t[e == 1]):
        at = t >= s
        n, nl, d = w[at].sum(), w[at & left].sum(), w[(t == s) & (e == 1)].sum()
        u += w[(t == s) & (e == 1) & left].sum() - d * nl / n
        v += d * (n - d) / (n - 1) * nl / n * (1 - nl / n) if n > 1 else 0
    return u * u / v if v > 1e-12 else 0.0


def test_poisson_weights(spark):
    w = spark.range(20_000).select(forest.bootstrap_weight(1, F.lit(0), F.col("id")).alias("w")).toPandas()["w"]
    share = [(w == k).mean() for k in range(4)]
    np.testing.assert_allclose(share, [math.exp(-1) / math.factorial(k) for k in range(4)], atol=0.015)


def test_every_split_is_the_best_logrank_cut_of_its_node(spark, frame, data, fitted):
    """With 8 edges and all times as bins: each split equals a search over all cuts of its node's tried features."""
    times = sorted(set(frame.duration))
    edges = [sorted({float(v) for v in np.quantile(frame[f], np.linspace(0, 1, 6)[1:-1], method="lower")}) for f in "abc"]
    binned = data.select(F.col("subject_id").alias("id"), "event", forest.bin_of(F.col("duration"), times).alias("tbin"),
                         F.array(*[forest.bin_of(F.col(f), e) for f, e in zip("abc", edges)]).alias("bins"))
    levels = forest.grow(binned, edges, len(times) + 1, SETTINGS)
    bag = data.select("subject_id", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("tree")).withColumn(
        "w", forest.bootstrap_weight(3, F.col("tree"), F.col("subject_id"))).toPandas()
    tried = {}
    rows = [(r.tree, r.node) for level in levels for r in level.collect()]
    for r in spark.createDataFrame(rows, "tree int, node long").withColumn(
            "f", forest.node_features(3, F.col("tree"), F.col("node"), 3, 1)).collect():
        tried[r.tree, r.node] = r.f
    found = {(r.tree, r.node): r for level in levels for r in level.collect()}
    assert len(found) > 20 and len(levels) > 2
    for tree in range(5):
        w = bag[bag.tree == tree].set_index("subject_id").w.reindex(frame.subject_id).to_numpy()
        inside = {1: w > 0}
        for node in sorted(n for t, n in found if t == tree):
            r, here = found[tree, node], inside[node]
            best = 0.0
            for f in tried[tree, node]:
                for cut in edges[f]:
                    left = (frame["abc"[f]] <= cut).to_numpy()
                    if min((here & left).sum(), (here & ~left).sum()) >= 5:
                        best = max(best, logrank(frame.duration.to_numpy()[here], frame.event.to_numpy()[here], w[here], left[here]))
            left = (frame["abc"[r.feature]] <= r.threshold).to_numpy()
            assert here.sum() >= 10 and r.statistic == pytest.approx(best, abs=1e-8)
            assert (r.n_left, r.n_right) == ((here & left).sum(), (here & ~left).sum())
            inside[2 * node], inside[2 * node + 1] = here & left, here & ~left


def test_nodes_of_few_rows_are_split_in_one_job_and_alike(spark, frame, data):
    times = sorted(set(frame.duration))
    edges = [sorted({float(v) for v in np.quantile(frame[f], np.linspace(0, 1, 9)[1:-1], method="lower")}) for f in "abc"]
    binned = data.select(F.col("subject_id").alias("id"), "event", forest.bin_of(F.col("duration"), times).alias("tbin"),
                         F.array(*[forest.bin_of(F.col(f), e) for f, e in zip("abc", edges)]).alias("bins"))
    tables = [[sorted(map(tuple, level.collect())) for level in forest.grow(binned, edges, len(times) + 1, SETTINGS, node_rows=n)]
              for n in (1, 40, 1000)]  # all by joins, the upper ones by joins, none by joins
    assert len(tables[0]) > 3 and tables[0] == tables[1] == tables[2]


def test_leaves_by_subtrees_and_blocks_are_those_of_the_joins(spark, frame, data, fitted):
    odd = frame.assign(a=[None, math.nan, math.inf, -math.inf, *frame.a[4:]]).astype({"a": object})
    rows = spark.createDataFrame([tuple(r) for r in odd[["subject_id", "a", "b", "c"]].itertuples(index=False)],
                                 "subject_id long, a double, b double, c double")
    pairs = rows.select("subject_id", F.array("a", "b", "c").alias("x"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("tree"))
    got = [sorted((r.subject_id, r.tree, r.node) for r in forest.leaf_of(pairs, fitted.levels, n).collect()) for n in (1, 3, 50, 1 << 16)]
    assert len(got[0]) == 800 and got[0] == got[1] == got[2] == got[3]


def walk(fitted, row):
    tables = {(r.tree, r.node): r for level in fitted.levels for r in level.collect()}
    out = {}
    for tree in range(fitted.settings.n_trees):
        node = 1
        while (tree, node) in tables:
            r = tables[tree, node]
            node = 2 * node + int(row["abc"[r.feature]] > r.threshold)
        out[tree] = node
    return out


def test_risk_is_the_sum_of_the_mean_hazards_over_all_event_times(frame, data, fitted):
    hazards = fitted.hazards.toPandas()
    union = sorted(set(frame.duration[frame.event == 1]))
    risk = fitted.risk(data).toPandas().set_index("subject_id").risk
    surv = fitted.survival(data, [2.0, 10.0, 1e9, -1.0]).toPandas().set_index(["subject_id", "time"]).survival
    for i in (0, 5, 77):
        leaves = walk(fitted, frame.loc[i])
        total, s2, s10 = [], [], []
        for tree, node in leaves.items():
            h = hazards[(hazards.tree == tree) & (hazards.node == node)]
            total.append(sum(h.h[h.time <= u].sum() for u in union))
            s2.append(np.prod(1 - h.h[h.time <= 2])); s10.append(np.prod(1 - h.h[h.time <= 10]))
        assert risk[i] == pytest.approx(np.mean(total), abs=1e-8)
        assert surv[i, 2.0] == pytest.approx(np.mean(s2)) and surv[i, 10.0] == pytest.approx(np.mean(s10))
        assert surv[i, 1e9] == pytest.approx(surv.loc[i].min()) and surv[i, -1.0] <= 1.0


def test_forest_learns_and_missing_features_go_left(spark, data, fitted):
    train = fitted.c_index(data).first().c_index
    held = fitted.c_index(data, fitted.out_of_bag_risk(data)).first().c_index
    assert train > 0.65 and 0.55 < held < train
    odd = spark.createDataFrame([(1, None, None, None), (2, -1e9, -1e9, -1e9)], "subject_id long, a double, b double, c double")
    got = {r.subject_id: r.risk for r in fitted.risk(odd).collect()}
    assert got[1] == got[2]


def test_forest_of_constant_features_is_one_leaf_a_tree(spark, frame):
    flat = spark.createDataFrame(frame.assign(a=1.0))
    model = forest.fit_forest(flat, ["a"], forest.GrowthSettings(n_trees=3))
    assert model.levels == [] and model.risk(flat).select("risk").distinct().count() == 1


def test_weights_on_arrays_are_those_of_the_column(spark):
    ids = [None, "", "7", "-12", "123456789012", "x" * 44, "x" * 45, "x" * 46, "x" * 90, "\u00e9" * 9, "0"]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "i int, id string")
    tails = rows.select("i", forest.tail_of(F.col("id")).alias("tail")).orderBy("i").toArrow().column("tail")
    got = bags.weights(42, 120, tails, forest.poisson_steps())
    want = rows.select("i", F.explode(F.sequence(F.lit(0), F.lit(119))).alias("tree"), "id").withColumn(
        "w", forest.bootstrap_weight(42, F.col("tree"), F.col("id"))).toPandas().pivot(index="tree", columns="i", values="w")
    assert (got == want.to_numpy()).all() and got.max() >= 4


def test_rows_of_the_same_bins_are_one_cell_and_one_set(spark, frame, monkeypatch):
    """Growth and scores of many equal rows search the leaves of a few sets, make no row a tree, and are those of all rows."""
    few = frame.assign(a=frame.a.clip(-1, 1).round(), b=frame.b.clip(-1, 1).round(), c=0.0, duration=frame.duration.clip(upper=9))
    many = pd.concat([few.assign(subject_id=few.subject_id + 1000 * k) for k in range(6)], ignore_index=True)
    rows = spark.createDataFrame(many)
    monkeypatch.setattr(forest, "first_level", None)
    searched, search = [], forest.leaf_of
    monkeypatch.setattr(forest, "leaf_of", lambda pairs, *a: searched.append(pairs.count()) or search(pairs, *a))
    results = []
    for limits in ({}, {"SETS": 2, "BLOCK": 50, "LEAF_ROWS": 99}):
        for name, value in limits.items():
            monkeypatch.setattr(forest, name, value)
        model = forest.fit_forest(rows, ["a", "b", "c"], SETTINGS, bins=8)
        splits = sorted(tuple(r) for level in model.levels for r in level.collect())
        risk = dict(model.risk(rows).collect())
        held = dict(model.out_of_bag_risk(rows).collect())
        results.append((splits, risk, held))
    assert len(results[0][0]) >= 5 and results[0] == results[1] and 0 < max(searched) <= 9 * 5
    # brute force: weights by the column, leaves by walking, hazards of leaves at all event times
    bag = rows.select("subject_id", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("tree")).withColumn(
        "w", forest.bootstrap_weight(3, F.col("tree"), F.col("subject_id"))).toPandas().pivot(index="subject_id", columns="tree", values="w")
    w, t, e = bag.reindex(many.subject_id).to_numpy(), many.duration.to_numpy(), many.event.to_numpy()
    at = {}
    tables = {(r[0], r[1]): r for r in splits}
    leaf, value = np.ones((len(many), 5), int), np.zeros((len(many), 5))
    for tree in range(5):
        for i in range(len(many)):
            while (tree, leaf[i, tree]) in tables:
                r = tables[tree, leaf[i, tree]]
                leaf[i, tree] = 2 * leaf[i, tree] + int(many.loc[i, "abc"[r[2]]] > r[4])
        for node in np.unique(leaf[:, tree]):
            here = leaf[:, tree] == node
            h = {s: w[here & (t == s) & (e == 1), tree].sum() / max(1, w[here & (t >= s), tree].sum()) for s in set(t[e == 1])}
            value[here, tree] = sum(sum(x for s, x in h.items() if s <= u) for u in h)
        at[tree] = (w[:, tree] > 0).sum()
        assert (tree, 1) not in tables or sum(tables[tree, 1][6:8]) == at[tree]
    np.testing.assert_allclose([results[0][1][i] for i in many.subject_id], value.mean(axis=1), atol=1e-8)
    outside = (w == 0).any(axis=1)
    assert sorted(results[0][2]) == sorted(many.subject_id[outside])
    mean = np.where(w == 0, value, 0).sum(axis=1)[outside] / (w == 0).sum(axis=1)[outside]
    np.testing.assert_allclose([results[0][2][i] for i in many.subject_id[outside]], mean, atol=1e-8)


def test_cells_of_many_features_and_thresholds_match_the_joins(spark, frame):
    """More thresholds than codes of a set have: values tell the sets; odd values go where the search sends them."""
    levels = [spark.createDataFrame([(0, 1, 0, 0.0), (1, 1, 1, 0.5)], "tree int, node long, feature int, threshold double"),
              spark.createDataFrame([(0, 2, 0, -1.0), (0, 3, 2, 0.3)], "tree int, node long, feature int, threshold double")]
    wide = spark.createDataFrame([(t, 1, 0, t / 7.0) for t in range(140)], "tree int, node long, feature int, threshold double")
    odd = frame.assign(a=[None, math.nan, math.inf, -math.inf, -0.0, 0.0, *frame.a[6:]]).astype({"a": object})
    rows = spark.createDataFrame([tuple(r) for r in odd[["subject_id", "a", "b", "c"]].itertuples(index=False)], "subject_id long, a double, b double, c double")
    for given, trees in ((levels, 2), ([wide], 140)):
        thresholds = forest.thresholds_of(given, 3)
        assert [t is None for t in thresholds] == [trees == 140, False, False]
        x = rows.select("subject_id", F.array("a", "b", "c").alias("x"))
        keyed = forest.with_sets(x, thresholds)
        leaves = {bytes(r.set): list(r.nodes) for r in forest.leaves_of_sets(forest.sets_of(keyed), given, trees).collect()}
        want = forest.leaf_of(x.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))), given)
        nodes = {(r.subject_id, r.tree): r.node for r in want.collect()}
        assert all(leaves[bytes(r.set)] == [nodes[r.subject_id, k] for k in range(trees)] for r in keyed.collect())


def test_boosting_learns_and_attributions_add_up(frame, data):
    model = boosting.fit_boosted_cox(data, ["a", "b"], n_estimators=5, subsample=1.0, bins=16)
    assert len(model.trees) == 5 and model.feature_importance()[0][0] == "a"
    got = model.attributions(data).toPandas()
    np.testing.assert_allclose(got.base + got.phi_a + got.phi_b, got.score, atol=1e-9)
    summary = model.attribution_summary(data).toPandas().set_index("feature").mean_abs
    assert summary["a"] == pytest.approx(got.phi_a.abs().mean()) and summary.index[0] == "a"
    # the first tree is fitted to the martingale residuals at score 0
    t, e = frame.duration.to_numpy(), frame.event.to_numpy()
    hazard = sum(np.where(t >= s, (e[t == s]).sum() / (t >= s).sum(), 0.0) for s in np.unique(t))
    residual, root = e - hazard, model.trees[0][1]
    left = frame.a.to_numpy() <= root.threshold
    assert root.value == pytest.approx(0, abs=1e-9) and model.trees[0][2].value == pytest.approx(residual[left].mean())
    assert all(n.rows >= 5 for tree in model.trees for n in tree.values())
    assert all(tree[k].rows >= 10 for tree in model.trees for k in tree if tree[k].feature >= 0)


def test_boosting_is_the_same_over_many_partitions_and_moves_no_rows_in_a_round(spark, frame, monkeypatch):
    tied = spark.createDataFrame(frame.assign(duration=np.minimum(frame.duration, 6.0)))  # times that reach over several partitions
    fit = lambda **k: boosting.fit_boosted_cox(tied, ["a", "b"], n_estimators=4, bins=16, checkpoint_every=2, **k)
    plans, made = [], boosting._per_part
    monkeypatch.setattr(boosting, "_per_part", lambda *a: plans.append(made(*a)) or plans[-1])
    one, many = fit(), fit(part_rows=9)
    assert plans and all("Exchange" not in p._jdf.queryExecution().toString() for p in plans)
    for x, y in zip(one.trees, many.trees):
        assert {k: (n.feature, n.bin, n.rows) for k, n in x.items()} == {k: (n.feature, n.bin, n.rows) for k, n in y.items()}
        assert [n.value for _, n in sorted(x.items())] == pytest.approx([n.value for _, n in sorted(y.items())], abs=1e-9)
    # residuals of the second tree's sample come from the score after the first
    t, e = tied.toPandas().duration.to_numpy(), frame.event.to_numpy()
    first = one.trees[0]
    boosted = boosting.BoostedCox(["a", "b"], 0.1, [first]).score(tied).toPandas().score.to_numpy()
    w = np.exp(boosted)
    hazard = sum(np.where(t >= s, e[t == s].sum() / w[t >= s].sum(), 0.0) for s in np.unique(t))
    used = tied.select(boosting.uniform_hash(F.col("subject_id"), 42 * 1000 + 1).alias("u")).toPandas().u.to_numpy() < 0.8
    assert one.trees[1][1].value == pytest.approx((e - w * hazard)[used].mean(), abs=1e-9)


@pytest.fixture(scope="module")
def models(data, fitted):
    return {"cox": scorers.CoxScorer(cox.fit_cox(data, ["a", "b", "c"], penalizer=0.1)),
            "boosted": scorers.BoostedScorer(boosting.fit_boosted_cox(data, ["a", "b", "c"], n_estimators=2), data), "forest": fitted}


@pytest.mark.parametrize("name", ["cox", "boosted", "forest"])
def test_any_scorer(spark, data, models, name):
    scorer = models[name]
    risk = scorer.risk(data.withColumn("k", F.lit("x")), ["k", "subject_id"])
    assert risk.columns == ["k", "subject_id", "risk"] and risk.count() == 160
    curves = scorers.patient_curves(scorer, data, step=5, horizon=20).toPandas().sort_values(["subject_id", "time"])
    assert len(curves) == 160 * 5 and curves.survival.between(0, 1).all()
    assert (curves.groupby("subject_id").survival.diff().dropna() <= 1e-12).all()
    row = scorers.evaluate(name, "made", scorer, data, data, [5.0, 10.0]).first()
    assert row.c_index > 0.55 and row.model == name
    lost = permutation_importance(data, ["a", "c"], scorer=scorer, repeats=2)
    got = {r.feature: r for r in lost.collect()}
    assert got["a"].importance > got["c"].importance and got["a"].repeats == 2 and got["a"].importance_std >= 0
    assert sum(r.importance for r in normalised(lost).collect()) == pytest.approx(1.0)
    requests = spark.createDataFrame([(1, 60, 5.0, 0.1), (2, 200, 3.0, 0.2)], "subject_id long, age int, los double, a double")
    scored, bad = scorers.score_requests(requests, scorer, model_name=name, times=(5, 10))
    assert [r.subject_id for r in scored.collect()] == [1] and [r.subject_id for r in bad.collect()] == [2]
    assert scored.columns == ["subject_id", "model", "survival_5d", "survival_10d", "risk_score"]
