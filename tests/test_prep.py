"""Feature preparation: right-closed buckets, imputation, scaling, split quotas, validation."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from hazardflow.functions.columns import AGE_BINS, AGE_LABELS, cut
from hazardflow.operators import prep


def test_cut_edges(spark):
    df = spark.createDataFrame([(45.0,), (60.0,), (75.0,), (None,), (0.0,), (45.5,)], "age double")
    got = [r[0] for r in df.select(cut(F.col("age"), AGE_BINS, AGE_LABELS)).collect()]
    assert got == ["<45", "45-60", "60-75", None, None, "45-60"]


def test_scaler_uses_train_parameters(spark):
    train = spark.createDataFrame([(1.0,), (2.0,), (None,), (4.0,)], "x double")
    test = spark.createDataFrame([(None,), (100.0,)], "x double")
    tr, feats, sc = prep.preprocess(train, ["x"])
    assert sc.median["x"] == 2.0
    vals = [r[0] for r in tr.collect()]
    assert abs(sum(vals)) < 1e-12 and abs(sum(v * v for v in vals) / 4 - 1) < 1e-12
    te, _, _ = prep.preprocess(test, feats, sc, fit=False)
    assert te.collect()[0][0] == pytest.approx((2.0 - sc.mean["x"]) / sc.std["x"])
    with pytest.raises(ValueError):
        prep.preprocess(test, feats, None, fit=False)


def test_split_quotas_disjoint_complete(spark):
    df = spark.range(1000).select(F.col("id").alias("subject_id"),
                                  (F.col("id") % 3 == 0).cast("int").alias("event"))
    out = prep.stratified_split(df, seed=7).toPandas()
    assert len(out) == 1000 and out["subject_id"].is_unique
    for ev, grp in out.groupby("event"):
        n = len(grp)
        n_test = math.floor(n * 0.15 + 0.5)
        n_val = math.floor((n - n_test) * (0.15 / 0.85) + 0.5)
        counts = grp["split"].value_counts()
        assert counts["test"] == n_test and counts["val"] == n_val


def test_validation_flags_bad_age(spark):
    df = spark.createDataFrame([(-5.0, 6.0), (70.0, None)], "age double, sofa_score double")
    rows = prep.validate_requests(df).collect()
    assert rows[0]["errors"] == ["age"]
    assert rows[1]["errors"] == [] and rows[1]["sofa_score"] == 6.0


def test_align_adds_missing(spark):
    df = spark.createDataFrame([(1, 2.0)], "subject_id long, a double")
    out = prep.align_features(df, ["b", "a"], keep=["subject_id"])
    assert out.columns == ["subject_id", "b", "a"] and out.collect()[0]["b"] == 0.0


def test_status_and_coded_normalisers(spark):
    from hazardflow.sources.clinical import normalise_coded_cohort, normalise_status_cohort

    raw = spark.createDataFrame([(5.0, 2, 1, 60.0, None), (7.0, 1, 1, 70.0, 1.0), (9.0, 2, 2, None, 3.0)],
                                "time double, status int, inst int, age double, `ph.ecog` double")
    out = normalise_status_cohort(raw).toPandas()
    assert list(out["event"]) == [1, 0, 1] and "ph_ecog" in out and "inst" not in out
    assert out["age"].tolist()[2] == 65.0 and out["ph_ecog"].tolist()[0] == 2.0
    coded = spark.createDataFrame([(1.0, 1, "yes", "Post", "III"), (2.0, 0, "no", "Pre", "x")],
                                  "time double, cens int, horTh string, menostat string, tgrade string")
    rows = normalise_coded_cohort(coded).collect()
    assert [(r.horTh, r.menostat, r.tgrade) for r in rows] == [(1, 1, 3), (0, 0, 2)]
