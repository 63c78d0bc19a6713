"""Cox kernel vs numpy brute force; C-index vs all-pairs count; prep edge cases."""

import numpy as np
import pandas as pd
import pytest

from hazardflow.operators import cox
from hazardflow.operators.concordance import concordance, concordance_by


def _efron_np(T, E, Z, beta):
    eta = Z @ beta; w = np.exp(eta); p = Z.shape[1]
    ll = 0.0; g = np.zeros(p); H = np.zeros((p, p))
    for tt in np.unique(T[E == 1]):
        risk = T >= tt; dead = (T == tt) & (E == 1); d = dead.sum()
        R0 = w[risk].sum(); R1 = (Z[risk] * w[risk, None]).sum(0); R2 = (Z[risk].T * w[risk]) @ Z[risk]
        D0 = w[dead].sum(); D1 = (Z[dead] * w[dead, None]).sum(0); D2 = (Z[dead].T * w[dead]) @ Z[dead]
        ll += eta[dead].sum(); g += Z[dead].sum(0)
        for l in range(d):
            c = l / d; phi = R0 - c * D0; v1 = R1 - c * D1
            ll -= np.log(phi); g -= v1 / phi; H -= (R2 - c * D2) / phi - np.outer(v1, v1) / phi ** 2
    return ll, g, H


@pytest.fixture(scope="module")
def cox_data(spark):
    rng = np.random.default_rng(0)
    n = 200
    x = rng.normal(size=(n, 2))
    t = np.round(rng.exponential(np.exp(-(0.7 * x[:, 0] - 0.3 * x[:, 1]))) * 10)
    e = (rng.uniform(size=n) < 0.7).astype(int)
    pdf = pd.DataFrame({"duration": t, "event": e, "a": x[:, 0], "b": x[:, 1],
                        "subject_id": np.arange(n)})
    return pdf, spark.createDataFrame(pdf)


def test_efron_kernel_equals_numpy(cox_data):
    pdf, df = cox_data
    Z = pdf[["a", "b"]].to_numpy()
    Z = (Z - Z.mean(0)) / Z.std(0, ddof=1)
    beta = np.array([0.3, -0.2])
    ll, g, H = _efron_np(pdf["duration"].to_numpy(), pdf["event"].to_numpy(), Z, beta)
    res = cox.score_at(df, ["a", "b"], beta)
    assert abs(res["ll"] - ll) < 1e-8
    assert np.allclose(res["grad"], g, atol=1e-8) and np.allclose(res["hess"], H, atol=1e-8)


def test_fit_score_zero_at_optimum(cox_data):
    pdf, df = cox_data
    m = cox.fit_cox(df, ["a", "b"], penalizer=0.1)
    assert m.converged
    res = cox.score_at(df, ["a", "b"], m.beta_norm)
    penalised = res["grad"] - m.n * 0.1 * m.beta_norm
    assert np.all(np.abs(penalised) < 1e-5)
    hr = cox.hazard_ratios(m)
    assert {r["feature"] for r in hr} == {"a", "b"}
    assert all(r["lower_95"] <= r["hr"] <= r["upper_95"] for r in hr)


def test_predictions_consistent(cox_data):
    pdf, df = cox_data
    m = cox.fit_cox(df, ["a", "b"], penalizer=0.1)
    surv = cox.predict_survival(m, df, [1.0, 5.0, 20.0]).toPandas()
    assert surv["survival"].between(0, 1).all()
    mono = surv.sort_values(["subject_id", "time"]).groupby("subject_id")["survival"].diff().dropna()
    assert (mono <= 1e-12).all()
    med = cox.predict_median(m, df).toPandas().set_index("subject_id")["median"]
    bl = m.baseline.toPandas().sort_values("time")
    lp = cox.predict_risk(m, df).toPandas().set_index("subject_id")["log_partial_hazard"]
    for sid in [0, 7, 42]:
        need = np.log(2) * np.exp(-lp[sid])
        hit = bl[bl["cum_hazard"] >= need]
        expect = hit["time"].min() if len(hit) else np.inf
        assert med[sid] == expect


def _pairs(t, e, r):
    conc = ties = comp = 0
    for i in range(len(t)):
        if e[i]:
            later = (t > t[i]) | ((t == t[i]) & (e == 0))
            comp += int(later.sum()); conc += int((later & (r < r[i])).sum()); ties += int((later & (r == r[i])).sum())
    return conc, ties, comp


@pytest.mark.parametrize("blocks", [None, 4, 64, 1024])
def test_keyed_cindex_does_not_depend_on_blocks(spark, blocks):
    rng = np.random.default_rng(3)
    n = 400
    t = rng.integers(0, 30, n).astype(float); r = rng.integers(-5, 6, n).astype(float); e = (rng.uniform(size=n) < 0.5).astype(int)
    k = np.where(np.arange(n) % 4 == 3, None, (np.arange(n) % 4).astype(object))
    df = spark.createDataFrame([(x if x is None else int(x), float(a), int(b), float(c)) for x, a, b, c in zip(k, t, e, r)],
                               "k int, duration double, event int, risk double")
    got = {row.k: (int(row.concordant), int(row.tied_risk), int(row.comparable)) for row in concordance_by(df, ["k"], n_blocks=blocks).collect()}
    for key in (0, 1, 2, None):
        m = np.array([x == key for x in k])
        assert got[key] == _pairs(t[m], e[m], r[m])


def test_cindex_without_rows_or_pairs(spark):
    empty = spark.createDataFrame([], "duration double, event int, risk double")
    one = spark.createDataFrame([(1.0, 1, 2.0), (float("nan"), 1, 2.0), (2.0, None, 1.0)], "duration double, event int, risk double")
    for df in (empty, one):
        got = concordance(df)
        assert got["comparable"] == got["concordant"] == got["tied_risk"] == 0 and np.isnan(got["c_index"])


def test_cindex_hot_values_equals_brute_force(spark):
    rng = np.random.default_rng(7)
    n = 300
    t = rng.integers(0, 25, n).astype(float); t[: n // 3] = 7.0
    e = (rng.uniform(size=n) < 0.6).astype(int)
    r = rng.integers(0, 15, n).astype(float); r[n // 3: n // 2] = 4.0
    df = spark.createDataFrame(pd.DataFrame({"duration": t, "event": e, "risk": r}))
    got = concordance(df, n_blocks=5)
    conc = ties = comp = 0
    for i in range(n):
        if not e[i]:
            continue
        later = (t > t[i]) | ((t == t[i]) & (e == 0))
        comp += later.sum(); conc += (later & (r < r[i])).sum(); ties += (later & (r == r[i])).sum()
    assert (got["concordant"], got["tied_risk"], got["comparable"]) == (conc, ties, comp)
    neg = concordance(df.withColumn("risk", -df["risk"]), n_blocks=5)
    assert neg["c_index"] == pytest.approx(1 - got["c_index"])
