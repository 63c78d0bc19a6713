"""Cox proportional hazards: penalised Newton fit with Efron ties, diagnostics and prediction.

Each Newton step is one Spark job over the (persisted) normalised input: per distinct time the
sums of ``e^eta``, ``x e^eta`` and ``x x' e^eta`` (all rows and deaths only), a descending scan for
the risk sets, and one aggregate of the Efron terms. Only the log-likelihood, the p-vector and
the p x p matrix reach the driver, which takes the Newton step. Penalty as lifelines documents:
``n * 0.5 * penalizer * ||beta_std||^2`` on standardised covariates (std with ddof=1).
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardflow.functions.stats import Z95, norm_sf2
from hazardflow.operators.scan import prefix_scan, value_edges


def _pairs(p: int) -> list[tuple[int, int]]:
    return [(j, k) for j in range(p) for k in range(j, p)]


@dataclass
class CoxModel:
    features: list[str]
    mean: np.ndarray
    std: np.ndarray
    beta_norm: np.ndarray
    penalizer: float = 0.0
    loglik: float = float("nan")
    n: int = 0
    n_events: int = 0
    iterations: int = 0
    converged: bool = False
    hessian: np.ndarray | None = None
    time_col: str = "duration"
    event_col: str = "event"
    baseline: DataFrame | None = field(default=None, repr=False)
    c_index: float | None = None

    def score(self, df: DataFrame) -> float:
        """COX-9: Harrell's C of the model's risk on ``df``; on the training rows it is kept as ``c_index``."""
        from hazardflow.operators.concordance import concordance

        return concordance(df.withColumn("_risk", self.log_partial_hazard()), time_col=self.time_col,
                           event_col=self.event_col, risk_col="_risk")["c_index"]

    @property
    def params(self) -> np.ndarray:
        return self.beta_norm / self.std

    @property
    def variance(self) -> np.ndarray:
        if self.hessian is None:
            return np.full((len(self.features),) * 2, np.nan)
        return np.linalg.inv(-self.hessian) / np.outer(self.std, self.std)

    def normalised(self, f: str, i: int) -> Column:
        return (F.col(f).cast("double") - F.lit(float(self.mean[i]))) / F.lit(float(self.std[i]))

    def log_partial_hazard(self) -> Column:
        """COX-7: ``(x - mean_train) . params`` as a literal expression (centred at train mean)."""
        expr = F.lit(0.0)
        for i, f in enumerate(self.features):
            expr = expr + self.normalised(f, i) * F.lit(float(self.beta_norm[i]))
        return expr


#: Terms of one time's tie correction that one row sums up.
TIE_CHUNK = 65_536


# ---------------------------------------------------------------- one Newton pass

def efron_pass(data: DataFrame, p: int, beta: np.ndarray, *, edges: Sequence[float],
               shift: float = 0.0, ties: str = "efron") -> dict:
    """Log partial likelihood, gradient and Hessian at ``beta`` over normalised columns z0..z{p-1}.

    ``data`` has ``time double, event int, z0..`` columns. Sums of ``e^eta`` use ``eta - shift``.
    """
    zs = [F.col(f"z{j}") for j in range(p)]
    eta = F.lit(0.0)
    for j in range(p):
        eta = eta + zs[j] * F.lit(float(beta[j]))
    ev = (F.col("event") > 0).cast("double")
    prs = _pairs(p)
    base = data.select("time", ev.alias("ev"), *zs, eta.alias("eta")).withColumn(
        "w", F.exp(F.col("eta") - F.lit(shift)))
    w, e = F.col("w"), F.col("ev")
    aggs = [F.sum(w).alias("a0"), F.sum(e).alias("d"), F.sum(e * w).alias("b0"),
            F.sum(e * F.col("eta")).alias("ee"), F.max("eta").alias("meta")]
    for j in range(p):
        aggs += [F.sum(zs[j] * w).alias(f"a1_{j}"), F.sum(e * zs[j] * w).alias(f"b1_{j}"),
                 F.sum(e * zs[j]).alias(f"e1_{j}")]
    for j, k in prs:
        aggs += [F.sum(zs[j] * zs[k] * w).alias(f"a2_{j}_{k}"),
                 F.sum(e * zs[j] * zs[k] * w).alias(f"b2_{j}_{k}")]
    per_time = base.groupBy("time").agg(*aggs)
    risk = {"r0": "a0", **{f"r1_{j}": f"a1_{j}" for j in range(p)},
            **{f"r2_{j}_{k}": f"a2_{j}_{k}" for j, k in prs}}
    sc = prefix_scan(per_time, [], "time", risk, descending=True, edges=edges)
    # one row per chunk of a time's tie terms, so that no task loops over all deaths of one time
    parts = F.greatest(F.ceil(F.col("d") / F.lit(float(TIE_CHUNK))).cast("long"), F.lit(1).cast("long"))
    sc = sc.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    sc = sc.withColumn("efr", efron_terms(F.col("d"), F.col("r0"), F.col("b0"), ties, F.col("chunk")))
    L, A0, A1 = F.col("efr.L"), F.col("efr.A0"), F.col("efr.A1")
    B0, B1, B2 = F.col("efr.B0"), F.col("efr.B1"), F.col("efr.B2")
    has, first_part = F.col("d") > 0, (F.col("chunk") == 0).cast("double")
    out = [F.sum(F.when(has, (F.col("ee") - F.col("d") * F.lit(shift)) * first_part - L)).alias("ll"),
           F.max("meta").alias("meta"), F.sum(F.col("d") * first_part).alias("n_events")]
    for j in range(p):
        r1, b1 = F.col(f"r1_{j}"), F.col(f"b1_{j}")
        out.append(F.sum(F.when(has, F.col(f"e1_{j}") * first_part - (r1 * A0 - b1 * A1))).alias(f"g_{j}"))
    for j, k in prs:
        r1j, r1k, b1j, b1k = (F.col(f"r1_{j}"), F.col(f"r1_{k}"), F.col(f"b1_{j}"), F.col(f"b1_{k}"))
        first = F.col(f"r2_{j}_{k}") * A0 - F.col(f"b2_{j}_{k}") * A1
        second = r1j * r1k * B0 - (r1j * b1k + b1j * r1k) * B1 + b1j * b1k * B2
        out.append(F.sum(F.when(has, -(first - second))).alias(f"h_{j}_{k}"))
    row = sc.agg(*out).collect()[0]
    grad = np.array([row[f"g_{j}"] or 0.0 for j in range(p)])
    hess = np.zeros((p, p))
    for j, k in prs:
        hess[j, k] = hess[k, j] = row[f"h_{j}_{k}"] or 0.0
    return {"ll": row["ll"] or 0.0, "grad": grad, "hess": hess,
            "max_eta": row["meta"] or 0.0, "n_events": int(row["n_events"] or 0)}


def efron_terms(d: Column, r0: Column, s0d: Column, ties: str = "efron", chunk: Column | None = None) -> Column:
    """Per event time: ``L = sum_l log phi_l``, ``A_m = sum c^m/phi``, ``B_m = sum c^m/phi^2``.

    ``phi_l = R0 - (l/d) S0_deaths``, ``l = 0..d-1`` (Efron); Breslow is ``l/d = 0``. With ``chunk``
    only the terms ``l`` of that chunk of ``TIE_CHUNK``; the chunks of a time add up to all.
    """
    chunk = F.lit(0).cast("long") if chunk is None else chunk
    if ties == "breslow":
        dd = F.when(chunk == 0, d.cast("double")).otherwise(F.lit(0.0))
        return F.struct((dd * F.log(r0)).alias("L"), (dd / r0).alias("A0"), F.lit(0.0).alias("A1"),
                        (dd / (r0 * r0)).alias("B0"), F.lit(0.0).alias("B1"), F.lit(0.0).alias("B2"))
    zero = F.struct(*[F.lit(0.0).alias(n) for n in ("L", "A0", "A1", "B0", "B1", "B2")])

    def step(acc, l):
        c = l.cast("double") / d.cast("double")
        phi = r0 - c * s0d
        inv = F.lit(1.0) / phi
        return F.struct((acc["L"] + F.log(phi)).alias("L"), (acc["A0"] + inv).alias("A0"),
                        (acc["A1"] + c * inv).alias("A1"), (acc["B0"] + inv * inv).alias("B0"),
                        (acc["B1"] + c * inv * inv).alias("B1"),
                        (acc["B2"] + c * c * inv * inv).alias("B2"))

    last = F.least(d.cast("long"), (chunk + 1) * F.lit(TIE_CHUNK)) - 1
    seq = F.sequence(chunk * F.lit(TIE_CHUNK), F.greatest(last, chunk * F.lit(TIE_CHUNK)))
    return F.when(d > 0, F.aggregate(seq, zero, step)).otherwise(zero)


# ---------------------------------------------------------------- fitting

def normalisation(df: DataFrame, features: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    aggs = []
    for f in features:
        aggs += [F.avg(F.col(f).cast("double")), F.stddev_samp(F.col(f).cast("double"))]
    row = df.agg(*aggs).collect()[0]
    mean = np.array([row[2 * i] or 0.0 for i in range(len(features))], dtype=float)
    std = np.array([row[2 * i + 1] or 0.0 for i in range(len(features))], dtype=float)
    std[~np.isfinite(std) | (std == 0)] = 1.0
    return mean, std


def _design(df: DataFrame, features: Sequence[str], mean, std, time_col, event_col) -> DataFrame:
    cols = [F.col(time_col).cast("double").alias("time"), F.col(event_col).cast("int").alias("event")]
    for i, f in enumerate(features):
        cols.append(((F.col(f).cast("double") - F.lit(float(mean[i]))) / F.lit(float(std[i])))
                    .alias(f"z{i}"))
    return df.select(*cols)


def fit_cox(df: DataFrame, features: Sequence[str], *, time_col: str = "duration",
            event_col: str = "event", penalizer: float = 0.1, ties: str = "efron",
            max_iter: int = 50, tol: float = 1e-7, n_blocks: int | None = None,
            train_c_index: bool = False) -> CoxModel:
    """COX-1: Newton-Raphson with step halving; rows with missing values are dropped (PREP-9).

    ``train_c_index`` adds the C-index on the training rows (COX-9), a pass of its own.
    """
    features = list(features)
    clean = df.select(time_col, event_col, *features).dropna()
    for f in features:
        clean = clean.where(~F.isnan(F.col(f).cast("double")))
    mean, std = normalisation(clean, features)
    data = _design(clean, features, mean, std, time_col, event_col).persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        n = data.count()
        if n == 0:
            raise ValueError("no complete rows to fit")
        edges = value_edges(data, "time", n_blocks or max(8, 2 * int(
            df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))))
        p = len(features)
        beta = np.zeros(p)

        def penalised(res, b):
            ll = res["ll"] - n * 0.5 * penalizer * float(b @ b)
            g = res["grad"] - n * penalizer * b
            h = res["hess"] - n * penalizer * np.eye(p)
            return ll, g, h

        res = efron_pass(data, p, beta, edges=edges, ties=ties)
        ll, g, h = penalised(res, beta)
        converged, it = False, 0
        for it in range(1, max_iter + 1):
            delta = np.linalg.solve(-h, g)
            step = 1.0
            while True:
                cand = beta + step * delta
                res_c = efron_pass(data, p, cand, edges=edges, shift=res["max_eta"], ties=ties)
                ll_c, g_c, h_c = penalised(res_c, cand)
                better = ll_c >= ll - 1e-12 * max(1.0, abs(ll))
                if better or step < 1e-4:
                    break
                step *= 0.5
            if not better:  # no step improves the likelihood: stay where we are
                break
            moved = float(np.linalg.norm(step * delta))
            change = abs(ll_c - ll)
            beta, res, ll, g, h = cand, res_c, ll_c, g_c, h_c
            if moved < tol or change < 1e-10 * max(1.0, abs(ll)):
                converged = True
                break
        if not converged:
            warnings.warn(f"Newton steps stopped after {it} iterations without convergence", stacklevel=2)
        model = CoxModel(features, mean, std, beta, penalizer, ll, n, res["n_events"], it,
                         converged, h, time_col, event_col)
        model.baseline = breslow_baseline(clean, model)
        if train_c_index:
            model.c_index = model.score(clean)
        return model
    finally:
        data.unpersist()


def score_at(df: DataFrame, features: Sequence[str], beta_norm: Sequence[float], *,
             time_col: str = "duration", event_col: str = "event", ties: str = "efron") -> dict:
    """COX-2: unpenalised log-likelihood, score vector and information at a given beta."""
    clean = df.select(time_col, event_col, *features).dropna()
    mean, std = normalisation(clean, features)
    data = _design(clean, features, mean, std, time_col, event_col)
    edges = value_edges(data, "time", 16)
    res = efron_pass(data, len(features), np.asarray(beta_norm, dtype=float), edges=edges, ties=ties)
    res["n"] = clean.count()
    return res


def model_from_coefficients(df: DataFrame, features: Sequence[str], beta_norm: Sequence[float], *,
                            time_col: str = "duration", event_col: str = "event") -> CoxModel:
    """A model at given standardised coefficients (normalisation from ``df``), baseline included."""
    clean = df.select(time_col, event_col, *features).dropna()
    mean, std = normalisation(clean, features)
    m = CoxModel(list(features), mean, std, np.asarray(beta_norm, dtype=float), time_col=time_col,
                 event_col=event_col)
    m.baseline = breslow_baseline(clean, m)
    return m


# ---------------------------------------------------------------- baseline and prediction

def breslow_baseline(df: DataFrame, model: CoxModel) -> DataFrame:
    """COX-5: ``h0(t) = d(t) / sum_{T >= t} exp(eta_c)``, cumulative by an ascending scan.

    One row per distinct time (0 at censor-only times), columns time, baseline_hazard, cum_hazard.
    """
    eta = model.log_partial_hazard()
    per = (df.where(F.col(model.time_col).isNotNull())
           .groupBy(F.col(model.time_col).cast("double").alias("time"))
           .agg(F.sum(F.exp(eta)).alias("ph"),
                F.sum((F.col(model.event_col) > 0).cast("long")).alias("d")))
    edges = value_edges(df.select(F.col(model.time_col).cast("double").alias("_t")), "_t",
                        max(8, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))))
    rs = prefix_scan(per, [], "time", {"risk": "ph"}, descending=True, edges=edges)
    hz = rs.withColumn("baseline_hazard", F.col("d").cast("double") / F.col("risk"))
    cum = prefix_scan(hz, [], "time", {"cum_hazard": "baseline_hazard"}, edges=edges)
    return cum.select("time", "baseline_hazard", "cum_hazard")


def baseline_at(model: CoxModel, times: Sequence[float], interpolate: bool = False) -> list[float]:
    """H0 at a few times (step by default; linear interpolation between times on request)."""
    from hazardflow.operators.nonparam import value_at

    if not interpolate:
        got = value_at(model.baseline, times, {"h": "cum_hazard"}, before_first={"h": 0.0}).collect()
        by_t = {r["time"]: r["h"] for r in got}
        return [float(by_t[float(t)]) for t in times]
    out = []
    bl = model.baseline
    for t in times:  # each lookup is a two-row aggregate over the curve
        row = bl.agg(
            F.max_by("cum_hazard", F.when(F.col("time") <= t, F.col("time"))).alias("h_lo"),
            F.max(F.when(F.col("time") <= t, F.col("time"))).alias("t_lo"),
            F.min_by("cum_hazard", F.when(F.col("time") > t, F.col("time"))).alias("h_hi"),
            F.min(F.when(F.col("time") > t, F.col("time"))).alias("t_hi")).collect()[0]
        if row["t_lo"] is None:
            out.append(float(row["h_hi"] or 0.0))
        elif row["t_hi"] is None:
            out.append(float(row["h_lo"]))
        else:
            fr = (t - row["t_lo"]) / (row["t_hi"] - row["t_lo"])
            out.append(float(row["h_lo"] + fr * (row["h_hi"] - row["h_lo"])))
    return out


def predict_survival(model: CoxModel, df: DataFrame, times: Sequence[float], *,
                     id_col: str = "subject_id", interpolate: bool = False) -> DataFrame:
    """COX-6: long ``(id, time, survival)`` with ``S = exp(-H0(t) exp(eta_c))``.

    H0 at the requested times is a handful of literals, so subjects are never joined to the curve.
    """
    h0 = baseline_at(model, times, interpolate)
    ph = F.exp(model.log_partial_hazard())
    rows = F.array(*[F.struct(F.lit(float(t)).alias("time"),
                              F.exp(-F.lit(h) * F.col("_ph")).alias("survival"))
                     for t, h in zip(times, h0)])
    return df.select(id_col, ph.alias("_ph")).select(id_col, F.inline(rows))


def predict_risk(model: CoxModel, df: DataFrame, *, id_col: str = "subject_id") -> DataFrame:
    """COX-7: ``(id, log_partial_hazard)``."""
    return df.select(id_col, model.log_partial_hazard().alias("log_partial_hazard"))


def predict_median(model: CoxModel, df: DataFrame, *, id_col: str = "subject_id") -> DataFrame:
    """COX-8: first baseline time with ``S <= 0.5``, i.e. ``H0(t) >= ln 2 / exp(eta_c)``; inf if never.

    As-of lookup without broadcasting the curve: distinct thresholds and curve rows (key = H0) are
    unioned, a descending running ``min(time)`` over the key is taken and joined back to the subjects.
    """
    thr = F.lit(math.log(2.0)) * F.exp(-model.log_partial_hazard())
    asked = df.select(F.col(id_col).alias("_id"), thr.alias("_key"))
    known = F.col("_key").isNotNull() & ~F.isnan("_key")
    keys = asked.where(known).select("_key").distinct().select(
        "_key", F.lit(None).cast("double").alias("_t"), F.lit(True).alias("_row"))
    curve = model.baseline.select(F.col("cum_hazard").alias("_key"), F.col("time").alias("_t"), F.lit(False).alias("_row"))
    scanned = prefix_scan(keys.unionByName(curve), [], "_key", {"_first": "_t"},
                          descending=True, how="min").where("_row").select("_key", "_first")
    medians = asked.where(known).join(scanned, "_key", "left").select(
        F.col("_id").alias(id_col), F.coalesce(F.col("_first"), F.lit(float("inf"))).alias("median"))
    return medians.unionByName(asked.where(~F.coalesce(known, F.lit(False))).select(
        F.col("_id").alias(id_col), F.lit(None).cast("double").alias("median")))  # a missing covariate: no prediction


# ---------------------------------------------------------------- summaries

def hazard_ratios(model: CoxModel, z: float = Z95) -> list[dict]:
    """COX-3: ``feature, coef, hr, se, lower_95, upper_95, p_value`` ordered by p."""
    se = np.sqrt(np.clip(np.diag(model.variance), 0, None))
    rows = []
    for i, f in enumerate(model.features):
        c = float(model.params[i])
        s = float(se[i])
        zval = c / s if s > 0 else float("nan")
        rows.append({"feature": f, "coef": c, "hr": math.exp(c), "se": s,
                     "lower_95": math.exp(c - z * s), "upper_95": math.exp(c + z * s),
                     "p_value": norm_sf2(zval) if s > 0 else float("nan")})
    return sorted(rows, key=lambda r: (math.isnan(r["p_value"]), r["p_value"]))


def hazard_ratio_table(model: CoxModel, spark) -> DataFrame:
    rows = hazard_ratios(model)
    return spark.createDataFrame(
        [(r["feature"], r["coef"], r["hr"], r["se"], r["lower_95"], r["upper_95"], r["p_value"])
         for r in rows],
        "feature string, coef double, hr double, se double, lower_95 double, upper_95 double, "
        "p_value double").withColumn("converged", F.lit(bool(model.converged)))


def schoenfeld_test(model: CoxModel, df: DataFrame) -> DataFrame:
    """COX-4: PH test on scaled Schoenfeld residuals with the rank time transform.

    Residual at each event = x - (risk-set weighted mean of x) (Breslow form); the statistic
    per covariate is ``(sum (g - gbar) r*)^2 / (D * V_kk * sum (g - gbar)^2)`` with ``r* = D V r``
    and g the rank of the event time; chi-square(1) p-values.
    """
    p = len(model.features)
    eta = model.log_partial_hazard()
    clean = df.select(model.time_col, model.event_col, *model.features).dropna()
    zs = [model.normalised(f, i).alias(f"z{i}") for i, f in enumerate(model.features)]
    base = clean.select(F.col(model.time_col).cast("double").alias("time"),
                        F.col(model.event_col).cast("int").alias("event"), *zs, eta.alias("eta"))
    w = F.exp(F.col("eta"))
    per = base.groupBy("time").agg(F.sum(w).alias("a0"),
                                   *[F.sum(F.col(f"z{j}") * w).alias(f"a1_{j}") for j in range(p)])
    rs = prefix_scan(per, [], "time", {"r0": "a0", **{f"r1_{j}": f"a1_{j}" for j in range(p)}},
                     descending=True)
    ev = base.where(F.col("event") > 0).join(rs.select("time", "r0", *[f"r1_{j}" for j in range(p)]),
                                             "time")
    # unscaled residuals on the original covariate scale: (z - zbar) * std
    resid = [((F.col(f"z{j}") - F.col(f"r1_{j}") / F.col("r0")) * F.lit(float(model.std[j])))
             .alias(f"r{j}") for j in range(p)]
    ev = ev.select("time", *resid)
    ranked = prefix_scan(ev.groupBy("time").agg(F.count(F.lit(1)).alias("k")), [], "time",
                         {"cum": "k"})
    ev = ev.join(ranked.select("time", "cum", "k"), "time")
    # rank of tied event times = average rank
    ev = ev.withColumn("g", F.col("cum") - (F.col("k") - 1) / 2.0)
    var = model.variance
    D = model.n_events or ev.count()
    sums = ev.agg(F.avg("g").alias("gbar"), F.count(F.lit(1)).alias("D")).collect()[0]
    gbar = sums["gbar"]
    scaled = []
    for j in range(p):
        expr = F.lit(0.0)
        for k in range(p):
            expr = expr + F.lit(float(D * var[j, k])) * F.col(f"r{k}")
        scaled.append(expr + F.lit(float(model.params[j])))
    gc = F.col("g") - F.lit(gbar)
    row = ev.agg(F.sum(gc * gc).alias("gg"),
                 *[F.sum(gc * scaled[j]).alias(f"s{j}") for j in range(p)]).collect()[0]
    out = []
    for j, f in enumerate(model.features):
        num = row[f"s{j}"] ** 2
        den = D * var[j, j] * row["gg"] if row["gg"] else float("nan")
        stat = float(num / den) if den else float("nan")
        pval = norm_sf2(math.sqrt(stat)) if stat == stat and stat >= 0 else float("nan")
        out.append((f, stat, pval, bool(pval > 0.05) if pval == pval else None))
    return df.sparkSession.createDataFrame(
        out, "feature string, test_statistic double, p_value double, assumption_holds boolean")
