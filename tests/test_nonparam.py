"""Hand-worked KM / NA / CIF cases and properties."""

import math

import numpy as np
import pandas as pd
import pytest

from hazardflow.operators import nonparam as npo
from hazardflow.operators.competing import cumulative_incidence


def _df(spark, rows, cols="duration double, event int"):
    return spark.createDataFrame(rows, cols)


def test_km_ties_and_censoring(spark):
    df = _df(spark, [(1.0, 1), (2.0, 1), (2.0, 0), (3.0, 1), (3.0, 1), (4.0, 0)])
    c = npo.km_curve(df).toPandas().sort_values("time")
    assert c["n_at_risk"].tolist() == [6, 5, 3, 1]
    assert np.allclose(c["survival"], [5 / 6, 2 / 3, 2 / 9, 2 / 9])
    # Nelson-Aalen with tie smoothing: 1/6, 1/5, 1/3 + 1/2
    assert np.allclose(c["cum_hazard"], np.cumsum([1 / 6, 1 / 5, 1 / 3 + 1 / 2, 0]))
    assert (c["lower"] <= c["survival"]).all() and (c["survival"] <= c["upper"]).all()


def test_all_censored_median_inf(spark):
    df = _df(spark, [(1.0, 0), (2.0, 0)])
    curve = npo.km_curve(df)
    med = npo.median_survival(curve).collect()[0]
    assert math.isinf(med["median"])
    assert curve.agg({"survival": "min"}).collect()[0][0] == 1.0


def test_last_subject_dies(spark):
    df = _df(spark, [(1.0, 0), (2.0, 1), (3.0, 1)])
    c = npo.km_curve(df).toPandas().sort_values("time")
    assert c["survival"].tolist()[-1] == 0.0
    assert c["upper"].tolist()[-1] == 0.0


def test_lookup_before_first_and_between(spark):
    df = _df(spark, [(2.0, 1), (4.0, 1), (6.0, 0)])
    curve = npo.km_curve(df)
    got = npo.value_at(curve, [1.0, 2.0, 5.0, 10.0], {"s": "survival", "h": "cum_hazard"},
                       before_first={"s": 1.0, "h": 0.0}).toPandas().sort_values("time")
    assert np.allclose(got["s"], [1.0, 2 / 3, 1 / 3, 1 / 3])
    assert got["h"].tolist()[0] == 0.0


def test_logrank_identical_groups_is_zero(spark):
    rows = [(float(t), e, g) for g in ("a", "b") for t, e in [(1, 1), (2, 0), (3, 1), (4, 1)]]
    df = spark.createDataFrame(rows, "duration double, event int, grp string")
    res = npo.logrank_test(df, "grp")
    assert abs(res["test_statistic"]) < 1e-12 and res["df"] == 1
    pw = npo.pairwise_logrank(df, "grp").collect()[0]
    assert abs(pw["test_statistic"]) < 1e-12


def test_logrank_two_groups_against_formula(spark):
    rng = np.random.default_rng(2)
    t = rng.integers(1, 20, 80).astype(float)
    e = rng.integers(0, 2, 80)
    g = np.where(np.arange(80) < 40, "a", "b")
    df = spark.createDataFrame(pd.DataFrame({"duration": t, "event": e, "grp": g}))
    o_e = v = 0.0
    for tt in np.unique(t):
        n = (t >= tt).sum(); na = ((t >= tt) & (g == "a")).sum()
        d = ((t == tt) & (e == 1)).sum(); da = ((t == tt) & (e == 1) & (g == "a")).sum()
        o_e += da - d * na / n
        if n > 1:
            v += d * (n - d) / (n - 1) * na / n * (1 - na / n)
    res = npo.logrank_test(df, "grp")
    assert abs(res["test_statistic"] - o_e ** 2 / v) < 1e-9


def test_cif_plus_survival_is_one(spark):
    rng = np.random.default_rng(4)
    n = 200
    df = spark.createDataFrame(pd.DataFrame({"duration": rng.integers(1, 30, n).astype(float),
                                             "cause": rng.integers(0, 3, n)}))
    cif = cumulative_incidence(df).toPandas()
    wide = cif.pivot_table(index="time", columns="cause", values="cif")
    s = cif.groupby("time")["survival"].first()
    assert np.allclose(wide.sum(axis=1) + s, 1.0)
    assert (wide.diff().fillna(0) >= -1e-12).all().all()
