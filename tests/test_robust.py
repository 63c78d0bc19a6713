"""Scans at cluster partition counts, NULL and NaN rows, long ties: the cases a small clean table doesn't show."""

import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hazardflow.functions.stats import erfc_col
from hazardflow.operators import cox
from hazardflow.operators.competing import cumulative_incidence
from hazardflow.operators.concordance import concordance
from hazardflow.operators.metrics import brier_scores
from hazardflow.operators.nonparam import na_increment
from hazardflow.operators.prep import stratified_split
from hazardflow.operators.quantiles import exact_percentiles
from hazardflow.operators.scan import block_of, prefix_scan, value_edges
from hazardflow.plans.comparison import cindex_pivot, full_comparison
from hazardflow.sources.sinks import list_models, register_model
from hazardflow.streaming.risk_table import stream_counts


@pytest.mark.parametrize("partitions", [200, 1000, 4000])
def test_blocks_and_scan_with_many_partitions(spark, partitions):
    rng = np.random.default_rng(partitions)
    x = np.round(rng.exponential(1000, 20_000), 2)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double")
    edges = value_edges(df, "x", 2 * partitions)
    assert len(edges) > partitions
    got = df.select("x", block_of(F.col("x"), edges).alias("b")).collect()
    for r in got:
        if r.x is None:
            assert r.b is None
        else:
            i = int(np.searchsorted(edges, r.x))
            assert r.b == 2 * i + (i < len(edges) and edges[i] == r.x)
    one = df.where("x is not null").groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    run = {r.x: r.run for r in prefix_scan(one, [], "x", {"run": "n"}, edges=edges).collect()}
    assert all(run[v] == c for v, c in zip(*(lambda u, n: (u, np.cumsum(n)))(*np.unique(x, return_counts=True))))


def test_null_keys_scan_like_any_other(spark):
    df = spark.createDataFrame([(k, float(i), i % 7) for k in (None, "a") for i in range(200)], "k string, t double, n int")
    w = Window.partitionBy("k").orderBy("t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    want = {(r.k, r.t): r.s for r in df.withColumn("s", F.sum("n").over(w)).collect()}
    assert {(r.k, r.t): r.s for r in prefix_scan(df, ["k"], "t", {"s": "n"}, n_blocks=16).collect()} == want


def test_null_groups_strata_and_percentiles(spark):
    rows = [(i, g, float(i % 50), i % 3) for g in (None, "a") for i in range(300)]
    df = spark.createDataFrame(rows, "subject_id int, g string, duration double, cause int")
    cif = cumulative_incidence(df, group_cols=["g"])
    assert {r.g for r in cif.select("g").distinct().collect()} == {"a"}
    pct = {r.g: r.value for r in exact_percentiles(df, "duration", [0.5], ["g"]).collect()}
    assert set(pct) == {None, "a"} and pct[None] == pct["a"]
    split = stratified_split(df.withColumn("event", F.col("g")), strata_col="event").groupBy("event", "split").count().collect()
    assert {(r.event, r.split): r["count"] for r in split}[None, "test"] == 45


def test_nan_risk_counts_nowhere(spark):
    rows = [(float(i), 1, float(-i) if i % 4 else float("nan")) for i in range(1, 80)]
    got = concordance(spark.createDataFrame(rows, "duration double, event int, risk double"))
    assert got["c_index"] == 1.0


def test_brier_without_censoring_mass_left(spark):
    train = spark.createDataFrame([(1, 1.0, 1), (2, 2.0, 0)], "subject_id int, duration double, event int")
    test = spark.createDataFrame([(1, 1.0, 1), (2, 9.0, 0)], "subject_id int, duration double, event int")
    pred = spark.createDataFrame([(1, 5.0, 0.2), (2, 5.0, 0.9)], "subject_id int, time double, survival double")
    got = {(r.metric, r.time): r.value for r in brier_scores(train, test, pred, [5.0]).collect()}
    assert got["brier", 5.0] == pytest.approx(0.2 ** 2 / 2)  # the term with G(5) = 0 counts as 0


@pytest.mark.parametrize(("n", "d"), [(1, 1), (5, 5), (40, 7), (257, 256), (300, 257), (10**9, 257), (10**11, 300), (10**7, 10**6)])
def test_nelson_aalen_step_is_one_path(spark, n, d):
    row = spark.createDataFrame([(n, d)], "n long, d long").select(na_increment(F.col("d"), F.col("n")).alias("v")).first()
    want = math.fsum(1.0 / (n - i) for i in range(d)) if d <= 10**6 else None
    assert row.v == pytest.approx(want, rel=1e-12)


def test_efron_chunks_add_up(spark, monkeypatch):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(float(i % 5), int(rng.integers(0, 3)), float(rng.normal())) for i in range(400)],
                               "duration double, event int, a double")
    whole = cox.score_at(df, ["a"], [0.4])
    monkeypatch.setattr(cox, "TIE_CHUNK", 7)
    parts = cox.score_at(df, ["a"], [0.4])
    assert parts["ll"] == pytest.approx(whole["ll"], rel=1e-12) and parts["n_events"] == whole["n_events"]
    assert np.allclose(parts["grad"], whole["grad"]) and np.allclose(parts["hess"], whole["hess"])
    ones = cox.score_at(df.withColumn("event", (F.col("event") > 0).cast("int")), ["a"], [0.4])
    assert ones["ll"] == pytest.approx(whole["ll"], rel=1e-12)  # a cause code 2 is one event


def test_median_of_missing_covariates_and_string_ids(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(f"s{i}", float(rng.exponential(10)), 1, float(rng.normal())) for i in range(100)],
                               "subject_id string, duration double, event int, a double")
    model = cox.fit_cox(df, ["a"])
    asked = df.limit(5).unionByName(spark.createDataFrame([("gone", 1.0, 1, None), (None, 1.0, 1, 0.0)], df.schema))
    got = {r.subject_id: r["median"] for r in cox.predict_median(model, asked).collect()}
    assert len(got) == 7 and got["gone"] is None and got[None] > 0 and math.isfinite(got[None])


def test_stream_counts_leave_out_unusable_rows(spark):
    rows = [("a", 1.0, 1), (None, 1.0, 1), ("a", float("nan"), 1), ("a", None, 1), ("a", 2.0, None)]
    df = spark.createDataFrame(rows, "g string, duration double, event int")
    assert [tuple(r) for r in stream_counts(df, ["g"]).collect()] == [("a", 1.0, 1, 1)]


def test_pivot_keeps_the_best_flag_and_columns_their_order(spark):
    rows = spark.createDataFrame([("m1", "x", 0.7), ("m2", "x", 0.8), ("m1", "y", 0.6)], "model string, dataset string, c_index double")
    got = {r.model: r.asDict() for r in cindex_pivot(rows, ["x", "y"]).collect()}
    assert got["m2"]["best_x"] and not got["m1"]["best_x"] and got["m1"]["best_y"] and got["m2"]["y"] is None
    assert full_comparison(rows, rows).columns[:3] == ["model", "c_index", "dataset"]


def test_registry_has_one_active_row_and_passes_errors_on(spark, tmp_path):
    path = str(tmp_path / "registry")
    register_model(spark, path, "a", 0.7, "d")
    register_model(spark, path, "b", 0.8, "d", make_active=True)
    spark.read.parquet(path).where("name = 'b'").withColumn("name", F.lit("c")).write.mode("append").parquet(path)
    models = list_models(spark.read.parquet(path)).collect()
    assert [m.name for m in models if m.is_active] == ["c"] and len(models) == 3


def test_erfc_column(spark):
    z = [0.0, 1e-6, 0.3, 1.0, 1.9999, 2.0, 3.3, 6.0, -1.5]
    got = [r.v for r in spark.createDataFrame([(i, v) for i, v in enumerate(z)], "i int, z double").orderBy("i").select(
        erfc_col(F.col("z")).alias("v")).collect()]
    assert got == pytest.approx([math.erfc(v) for v in z], rel=1e-11)


def test_boosted_survival_without_trees_is_the_breslow_curve(spark):
    from hazardflow.operators.boosting import BoostedCox, predict_survival

    df = spark.createDataFrame([(i, float(t), e, 0.0) for i, (t, e) in enumerate([(1, 1), (2, 1), (2, 0), (4, 1)])],
                               "subject_id int, duration double, event int, a double")
    got = {(r.subject_id, r.time): r.survival for r in predict_survival(BoostedCox(["a"], 0.1), df, df, [0.5, 2.0, 9.0]).collect()}
    assert got[0, 0.5] == 1.0
    assert got[3, 2.0] == pytest.approx(math.exp(-(1 / 4 + 1 / 3)))
    assert got[1, 9.0] == pytest.approx(math.exp(-(1 / 4 + 1 / 3 + 1)))


def test_batch_admission_carries_state_across_arrow_batches(spark):
    from hazardflow.streaming.admission import admit_batch

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.createDataFrame([(k, i, f"2024-01-01 00:{i // 4:02d}:{i % 4 * 15:02d}") for k in (1, None) for i in range(100)],
                                   "user_id long, event_id long, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        got = admit_batch(df, window=60.0, limit=3).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    kept, want = [], []
    for i in range(100):
        t = i * 15.0
        kept = [s for s in kept if t - s <= 60.0]
        want.append(len(kept) < 3)
        kept += [t] * want[-1]
    for k in (1, None):
        assert [r.admitted for r in sorted((r for r in got if r.user_id == k), key=lambda r: r.event_id)] == want


def test_prepare_cohort_and_train_c_index(spark):
    from hazardflow.operators.prep import prepare_cohort

    rng = np.random.default_rng(4)
    rows = [(i, float(rng.exponential(10)), int(i % 3 > 0), float(rng.normal()) if i % 11 else None, int(20 + i % 70)) for i in range(400)]
    done = prepare_cohort(spark.createDataFrame(rows, "subject_id int, duration double, event int, a double, age int"))
    sizes = [d.count() for d in (done.train, done.val, done.test)]
    assert sum(sizes) == 400 and sizes[2] == 60 and done.features == ["a", "age"]
    stats = done.train.agg(F.avg("a"), F.stddev_pop("a"), F.count("a")).first()
    assert stats[0] == pytest.approx(0, abs=1e-9) and stats[1] == pytest.approx(1) and stats[2] == sizes[0]
    model = cox.fit_cox(done.train, done.features, train_c_index=True)
    assert model.c_index == pytest.approx(model.score(done.train)) and 0 < model.c_index < 1
