"""Evaluation metrics over long prediction tables (EV-2..6, EV-8).

Predictions are long: ``(subject_id, time, survival)``; outcomes ``(subject_id, duration, event)``.
Everything is grouped by the few requested times; curve lookups for every subject use the
union-and-scan as-of join, so no curve is broadcast and no subject is paired with another.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardflow.operators.nonparam import risk_table
from hazardflow.operators.quantiles import exact_percentiles
from hazardflow.operators.scan import null_safe_join, prefix_scan


def censoring_curve(train: DataFrame, *, time_col: str = "duration", event_col: str = "event") -> DataFrame:
    """EV-2: reverse KM ``G(t)``; at tied times events leave before censorings.

    ``G = prod (1 - c / (n - d))``; columns ``time, censoring_survival``.
    """
    rt = risk_table(train, time_col=time_col, event_col=event_col)
    at_risk = F.col("n_at_risk") - F.col("d")
    c = F.col("c").cast("double")
    alive = c < at_risk
    terms = {"_logs": F.when(alive, F.log(F.lit(1.0) - c / at_risk.cast("double"))).otherwise(F.lit(0.0)),
             "_zero": F.when(alive | (F.col("c") == 0), F.lit(0)).otherwise(F.lit(1))}
    sc = prefix_scan(rt, [], "time", terms)
    return sc.select("time", F.when(F.col("_zero") > 0, F.lit(0.0))
                     .otherwise(F.exp(F.col("_logs"))).alias("censoring_survival"))


def asof_lookup(left: DataFrame, key_col: str, curve: DataFrame, curve_key: str, value_col: str,
                out_col: str, before_first: float) -> DataFrame:
    """Right-continuous step lookup for every row of ``left``: value at the last curve key <= key.

    The *distinct* keys and the curve points are unioned and a running ``max(struct(key, value))`` is
    scanned over the key; rows get their value by an equi-join, whose large partitions Spark can split.
    Neither side is broadcast, the curve may be as large as the data, and a key that many rows share
    is one row of the scan.
    """
    rows = left.withColumn("_k", F.col(key_col).cast("double"))
    asked = rows.select("_k").distinct().select(
        "_k", F.lit(True).alias("_is_row"), F.lit(None).cast("struct<k:double,v:double>").alias("_pt"))
    points = curve.select(F.col(curve_key).cast("double").alias("_k"), F.lit(False).alias("_is_row"),
                          F.struct(F.col(curve_key).cast("double").alias("k"),
                                   F.col(value_col).cast("double").alias("v")).alias("_pt"))
    found = prefix_scan(asked.unionByName(points), [], "_k", {"_last": "_pt"}, how="max").where("_is_row").select(
        "_k", F.coalesce(F.col("_last.v"), F.lit(float(before_first))).alias(out_col))
    return null_safe_join(rows, found, ["_k"]).drop("_k")


def valid_times(outcomes: DataFrame, times: Sequence[float], *, time_col: str = "duration",
                factor: float = 1.0) -> list[float]:
    tmax = outcomes.agg(F.max(time_col)).collect()[0][0]
    if tmax is None:
        return []
    return [float(t) for t in times if t < tmax * factor]


def brier_scores(train: DataFrame, test: DataFrame, predictions: DataFrame, times: Sequence[float], *,
                 id_col: str = "subject_id", time_col: str = "duration", event_col: str = "event") -> DataFrame:
    """EV-3/EV-4: IPCW Brier at each valid time and the integrated score.

    ``BS(t) = mean[S^2 1(T<=t, event)/G(T) + (1-S)^2 1(T>t)/G(t)]`` over test subjects; times
    ``>= max(T_test)`` are dropped. Long output ``(metric, time, value)``; ``ibs`` has a NULL time.
    """
    spark = test.sparkSession
    ok = valid_times(test, times, time_col=time_col)
    if not ok:
        warnings.warn("every requested time is beyond the follow-up", stacklevel=2)
        return spark.createDataFrame([], "metric string, time double, value double")
    g = censoring_curve(train, time_col=time_col, event_col=event_col)
    g_at_t = {r["q"]: r["g"] for r in g.select(F.explode(F.array(*[F.lit(t) for t in ok])).alias("q"),
                                               "time", "censoring_survival")
              .groupBy("q").agg(F.max_by("censoring_survival",
                                         F.when(F.col("time") <= F.col("q"), F.col("time"))).alias("g"))
              .collect()}
    subj = test.select(F.col(id_col).alias("_id"), F.col(time_col).cast("double").alias("_T"),
                       (F.col(event_col) > 0).alias("_E"))
    subj = asof_lookup(subj, "_T", g, "time", "censoring_survival", "_G_T", 1.0)
    known = {t: 1.0 if g_at_t.get(t) is None else float(g_at_t[t]) for t in ok}  # before the first time G is 1
    g_t = F.coalesce(*[F.when(F.col("time") == F.lit(t), F.lit(known[t])) for t in ok])
    pred = predictions.where(F.col("time").isin(ok)).select(
        F.col(id_col).alias("_id"), F.col("time").cast("double").alias("time"), "survival")
    j = pred.join(subj, "_id")
    s = F.col("survival")
    term = (F.when(F.col("_E") & (F.col("_T") <= F.col("time")) & (F.col("_G_T") > 0),
                   s * s / F.col("_G_T")).otherwise(F.lit(0.0))
            + F.when((F.col("_T") > F.col("time")) & (g_t > 0), (F.lit(1.0) - s) * (F.lit(1.0) - s) / g_t)
            .otherwise(F.lit(0.0)))
    bs = j.groupBy("time").agg(F.avg(term).alias("value"))
    rows = sorted((r["time"], r["value"]) for r in bs.collect())
    out = [("brier", t, v) for t, v in rows]
    if len(rows) >= 2:
        area = sum((rows[i + 1][0] - rows[i][0]) * (rows[i + 1][1] + rows[i][1]) / 2
                   for i in range(len(rows) - 1))
        out.append(("ibs", None, area / (rows[-1][0] - rows[0][0])))
    else:
        out.append(("ibs", None, None))
    return spark.createDataFrame(out, "metric string, time double, value double")


def time_auc(train: DataFrame, test: DataFrame, risk: DataFrame, times: Sequence[float], *,
             id_col: str = "subject_id", risk_col: str = "risk", time_col: str = "duration",
             event_col: str = "event") -> DataFrame:
    """EV-5: cumulative/dynamic AUC with IPCW case weights ``1/G(T_i)``; ties count 1/2.

    Per requested time: a weighted Mann-Whitney count by a scan over the risk value.
    Times ``>= 0.99 max(T_test)`` are dropped. Output ``(time, auc)``.
    """
    spark = test.sparkSession
    ok = valid_times(test, times, time_col=time_col, factor=0.99)
    if not ok:
        warnings.warn("every requested time is beyond the follow-up", stacklevel=2)
        return spark.createDataFrame([], "time double, auc double")
    g = censoring_curve(train, time_col=time_col, event_col=event_col)
    subj = test.select(F.col(id_col).alias("_id"), F.col(time_col).cast("double").alias("_T"),
                       (F.col(event_col) > 0).alias("_E"))
    subj = asof_lookup(subj, "_T", g, "time", "censoring_survival", "_G_T", 1.0)
    subj = subj.join(risk.select(F.col(id_col).alias("_id"), F.col(risk_col).cast("double").alias("r")),
                     "_id")
    long = subj.select("*", F.explode(F.array(*[F.lit(t) for t in ok])).alias("t"))
    case_w = F.when(F.col("_E") & (F.col("_T") <= F.col("t")) & (F.col("_G_T") > 0),
                    F.lit(1.0) / F.col("_G_T")).otherwise(F.lit(0.0))
    ctrl = F.when(F.col("_T") > F.col("t"), F.lit(1.0)).otherwise(F.lit(0.0))
    per = long.groupBy("t", "r").agg(F.sum(case_w).alias("w"), F.sum(ctrl).alias("k"))
    sc = prefix_scan(per, ["t"], "r", {"k_le": "k"})
    auc = sc.groupBy("t").agg(
        F.sum(F.col("w") * (F.col("k_le") - F.col("k") + F.lit(0.5) * F.col("k"))).alias("num"),
        F.sum("w").alias("wt"), F.sum("k").alias("nk"))
    return auc.select(F.col("t").alias("time"),
                      F.when((F.col("wt") > 0) & (F.col("nk") > 0),
                             F.col("num") / (F.col("wt") * F.col("nk"))).alias("auc"))


def calibration(test: DataFrame, predictions: DataFrame, times: Sequence[float], n_bins: int = 10, *,
                id_col: str = "subject_id", time_col: str = "duration", event_col: str = "event",
                overlap: bool = False, min_count: int = 5) -> DataFrame:
    """EV-6: predicted vs KM-observed survival in percentile bins of the prediction at each time.

    Edges are the interpolated percentiles ``linspace(0, 100, n_bins + 1)`` with duplicates removed;
    bins are half-open and the last one closed (``overlap=True`` closes both ends as the reference
    did). Bins with fewer than ``min_count`` subjects are dropped. ``bin_mid`` is rounded to 3 places.
    """
    from hazardflow.operators.nonparam import km_curve

    spark = test.sparkSession
    pred = predictions.where(F.col("time").isin([float(t) for t in times]))
    probs = [i / n_bins for i in range(n_bins + 1)]
    q = exact_percentiles(pred, "survival", probs, ["time"], small_groups=True).collect()
    edges: dict[float, list[float]] = {}
    for r in q:
        edges.setdefault(r["time"], []).append(r["value"])
    bins = []
    for t, es in edges.items():
        es = sorted(set(e for e in es if e is not None))
        for i, (lo, hi) in enumerate(zip(es[:-1], es[1:])):
            bins.append((float(t), i, float(lo), float(hi), i == len(es) - 2))
    if not bins:
        return spark.createDataFrame([], "time double, bin_mid double, predicted double, "
                                         "observed double, n long")
    rows = []
    for t, i, lo, hi, last in bins:
        upper_ok = (F.col("survival") <= hi) if (last or overlap) else (F.col("survival") < hi)
        rows.append(F.when((F.col("time") == t) & (F.col("survival") >= lo) & upper_ok,
                           F.struct(F.lit(i).alias("bin"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))))
    tagged = pred.select(F.col(id_col).alias("_id"), "time", "survival",
                         F.explode(F.array_compact(F.array(*rows))).alias("b"))
    tagged = tagged.select("_id", F.col("time").alias("qt"), "survival", "b.bin", "b.lo", "b.hi")
    subj = test.select(F.col(id_col).alias("_id"), F.col(time_col).alias("duration"),
                       F.col(event_col).alias("event"))
    joined = tagged.join(subj, "_id")
    stats = joined.groupBy("qt", "bin", "lo", "hi").agg(F.avg("survival").alias("predicted"),
                                                       F.count(F.lit(1)).alias("n"))
    curve = km_curve(joined, ["qt", "bin"], small_groups=True)
    obs = curve.groupBy("qt", "bin").agg(
        F.max_by("survival", F.when(F.col("time") <= F.col("qt"), F.col("time"))).alias("_s"))
    out = stats.join(obs, ["qt", "bin"], "left").where(F.col("n") >= min_count)
    return out.select(F.col("qt").alias("time"),
                      F.round((F.col("lo") + F.col("hi")) / 2, 3).alias("bin_mid"),
                      "predicted", F.coalesce(F.col("_s"), F.lit(1.0)).alias("observed"), "n")


def crude_brier(test: DataFrame, predictions: DataFrame, times: Sequence[float], *,
                id_col: str = "subject_id", time_col: str = "duration") -> DataFrame:
    """EV-8: ``mean((S(t) - 1(T > t))^2)`` without censoring weights (censored-before-t count as 0)."""
    pred = predictions.where(F.col("time").isin([float(t) for t in times]))
    j = pred.join(test.select(F.col(id_col), F.col(time_col).cast("double").alias("_T")), id_col)
    alive = F.when(F.col("_T") > F.col("time"), F.lit(1.0)).otherwise(F.lit(0.0))
    return j.groupBy("time").agg(F.avg(F.pow(F.col("survival") - alive, 2)).alias("brier"))

