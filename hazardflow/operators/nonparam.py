"""Risk tables, Kaplan-Meier, Nelson-Aalen, bands, curve lookups, medians and log-rank tests.

All curves are long tables ``(*groups, time, n_at_risk, d, c, ...)`` with one row per distinct
observed time (event or censoring) of the group, built by two distributed scans: a descending
scan of counts (risk set) and an ascending scan of per-time terms (product / sums).
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardflow.functions.stats import Z95, chi2_sf, chi2_sf_col1
from hazardflow.operators.scan import default_blocks, prefix_scan, value_edges


# A product that is exactly 1/2 in rational arithmetic comes out of the log-space sum a few ulps
# either side of 0.5; crossings are taken with this tolerance.
HALF_TOL = 1e-12


def _groups(group_cols: str | Sequence[str] | None) -> list[str]:
    if group_cols is None:
        return []
    if isinstance(group_cols, str):
        return [group_cols]
    return list(group_cols)


def time_edges(cohort: DataFrame, time_col: str = "duration", n_blocks: int | None = None) -> list[float]:
    """Block edges of the time axis, computed once and shared by every scan of one curve."""
    return value_edges(cohort.select(F.col(time_col).cast("double").alias("_t")), "_t",
                       n_blocks or default_blocks(cohort))


def risk_table(cohort: DataFrame, group_cols=None, *, time_col: str = "duration",
               event_col: str = "event", small_groups: bool = False,
               n_blocks: int | None = None, edges: Sequence[float] | None = None) -> DataFrame:
    """NP-1: per (group, time) ``n_total``, deaths ``d`` (any cause > 0), censored ``c``, ``n_at_risk``.

    Rows with a NULL group, time or event are left out (they belong to no curve).
    """
    g = _groups(group_cols)
    keep = F.col(time_col).isNotNull() & F.col(event_col).isNotNull() & ~F.isnan(F.col(time_col))
    for c in g:
        keep = keep & F.col(c).isNotNull()
    counts = (
        cohort.where(keep)
        .groupBy(*g, F.col(time_col).cast("double").alias("time"))
        .agg(F.count(F.lit(1)).alias("n_total"),
             F.sum((F.col(event_col) > 0).cast("long")).alias("d"))
    )
    scanned = prefix_scan(counts, g, "time", {"n_at_risk": "n_total"}, descending=True, n_blocks=n_blocks, edges=edges)
    return scanned.select(*g, "time", "n_at_risk", "d", (F.col("n_total") - F.col("d")).alias("c"),
                          "n_total")


def harmonic_difference(n: Column, m: Column, direct_upto: int = 32) -> Column:
    """``1/(m+1) + .. + 1/n`` without cancellation, for any 0 <= m <= n.

    Terms up to ``direct_upto`` are added one by one; above, the differences of the terms of the
    asymptotic series are taken in closed form (the rest is below 4e-15).
    """
    low = F.greatest(m, F.least(n, F.lit(direct_upto)))
    few = F.when(low > m, F.aggregate(F.sequence(m + 1, low), F.lit(0.0), lambda acc, i: acc + F.lit(1.0) / i)).otherwise(F.lit(0.0))
    a, b = n.cast("double"), low.cast("double")
    x, y = F.lit(1.0) / a, F.lit(1.0) / b
    gap = (a - b) * x * y  # 1/b - 1/a
    squares, product = x * x + y * y, x * x * y * y
    series = (-F.log1p(-(a - b) * x) - gap / 2 + gap * (x + y) / 12 - gap * (x + y) * squares / 120
              + gap * (x + y) * (squares * squares - product) / 252)
    return few + F.when(n > low, series).otherwise(F.lit(0.0))


def na_increment(d: Column, n: Column, smoothing: bool = True) -> Column:
    """Nelson-Aalen step at one time: ``sum_{i<d} 1/(n-i)`` (tie-smoothed) or ``d/n``."""
    if not smoothing:
        return F.when(d > 0, d / n).otherwise(F.lit(0.0))
    return F.when(d <= 0, F.lit(0.0)).otherwise(harmonic_difference(n, n - d))


def km_curve(cohort: DataFrame, group_cols=None, *, time_col: str = "duration",
             event_col: str = "event", z: float = Z95, na_smoothing: bool = True,
             small_groups: bool = False, n_blocks: int | None = None,
             table: DataFrame | None = None) -> DataFrame:
    """NP-2/3/4/9: KM survival, log-log Greenwood band and Nelson-Aalen hazard per group.

    ``S = exp(sum log(1 - d/n))``; from the first time with ``d = n`` on, ``S = 0``.
    Columns: groups, time, n_at_risk, d, c, survival, var_greenwood, lower, upper, cum_hazard.
    """
    g = _groups(group_cols)
    edges = None
    if table is None:
        edges = time_edges(cohort, time_col, n_blocks)
    rt = table if table is not None else risk_table(
        cohort, g, time_col=time_col, event_col=event_col, small_groups=small_groups,
        n_blocks=n_blocks, edges=edges)
    d, n = F.col("d").cast("double"), F.col("n_at_risk").cast("double")
    alive = F.col("d") < F.col("n_at_risk")
    sums = {
        "_logs": F.when(alive, F.log(F.lit(1.0) - d / n)).otherwise(F.lit(0.0)),
        "_zero": F.when(alive, F.lit(0)).otherwise(F.lit(1)),
        "var_greenwood": F.when(alive, d / (n * (n - d))).otherwise(F.lit(0.0)),
        "cum_hazard": na_increment(F.col("d"), F.col("n_at_risk"), na_smoothing),
    }
    sc = prefix_scan(rt, g, "time", sums, n_blocks=n_blocks, edges=edges)
    s = F.when(F.col("_zero") > 0, F.lit(0.0)).otherwise(F.exp(F.col("_logs")))
    sc = sc.withColumn("survival", s)
    return sc.select(*g, "time", "n_at_risk", "d", "c", "survival", "var_greenwood",
                     *loglog_band(F.col("survival"), F.col("var_greenwood"), z), "cum_hazard")


def loglog_band(s: Column, var: Column, z: float = Z95) -> list[Column]:
    """NP-3: ``S ** exp(-+ z sqrt(V) / ln S)``; S = 1 and S = 0 give a degenerate band."""
    inner = F.when((s > 0) & (s < 1), F.lit(z) * F.sqrt(var) / F.log(s))
    lower = F.when(s >= 1, F.lit(1.0)).when(s <= 0, F.lit(0.0)).otherwise(
        F.pow(s, F.exp(-inner)))
    upper = F.when(s >= 1, F.lit(1.0)).when(s <= 0, F.lit(0.0)).otherwise(
        F.pow(s, F.exp(inner)))
    return [lower.alias("lower"), upper.alias("upper")]


def value_at(curve: DataFrame, times: Sequence[float], value_cols=None, group_cols=None,
             before_first=None) -> DataFrame:
    """NP-5/6: right-continuous step lookup at a few requested times (as-of, t_curve <= q).

    ``value_cols`` maps output column -> curve column; ``before_first`` maps output column -> value
    before the first curve time (survival 1, cumulative hazard 0). The request list is small and
    literal: it is exploded onto the curve rows, no join.
    """
    g = _groups(group_cols)
    value_cols = value_cols or {"survival": "survival"}
    if isinstance(value_cols, str):
        value_cols = {value_cols: value_cols}
    before_first = before_first or {}
    qs = F.array(*[F.lit(float(t)) for t in times])
    long = curve.select(*g, "time", *set(value_cols.values()), F.explode(qs).alias("q"))
    upto = F.when(F.col("time") <= F.col("q"), F.col("time"))
    hit = long.groupBy(*g, "q").agg(
        *[F.max_by(F.col(src), upto).alias(f"_v_{out}") for out, src in value_cols.items()],
        F.min("time").alias("_first"))
    default = {"survival": 1.0, "cum_hazard": 0.0}
    outs = []
    for out, src in value_cols.items():
        before = before_first.get(out, default.get(src, 1.0))
        outs.append(F.when(F.col("q") < F.col("_first"), F.lit(float(before)))
                    .otherwise(F.col(f"_v_{out}")).alias(out))
    return hit.select(*g, F.col("q").alias("time"), *outs)


def median_survival(curve: DataFrame, group_cols=None) -> DataFrame:
    """NP-7/8: first time with S <= 0.5 (inf if never) and its band crossings, in the right order."""
    g = _groups(group_cols)
    inf = F.lit(float("inf"))
    half = F.lit(0.5 + HALF_TOL)
    return curve.groupBy(*g).agg(
        F.coalesce(F.min(F.when(F.col("survival") <= half, F.col("time"))), inf).alias("median"),
        F.coalesce(F.min(F.when(F.col("lower") <= half, F.col("time"))), inf).alias("ci_lower"),
        F.coalesce(F.min(F.when(F.col("upper") <= half, F.col("time"))), inf).alias("ci_upper"),
    )


def subgroup_medians(cohort: DataFrame, group_col: str, *, time_col: str = "duration",
                     event_col: str = "event", curve: DataFrame | None = None) -> DataFrame:
    """NP-10: ``group, median_survival, n_subjects, n_events`` sorted by group."""
    curve = curve if curve is not None else km_curve(cohort, [group_col], time_col=time_col,
                                                     event_col=event_col, small_groups=True)
    med = median_survival(curve, [group_col]).select(group_col, F.col("median").alias("median_survival"))
    cnt = (cohort.where(F.col(group_col).isNotNull())
           .groupBy(group_col)
           .agg(F.count(F.lit(1)).alias("n_subjects"),
                F.sum((F.col(event_col) > 0).cast("long")).alias("n_events")))
    return (med.join(cnt, group_col).select(F.col(group_col).cast("string").alias("group"),
                                            "median_survival", "n_subjects", "n_events")
            .orderBy("group"))


# ---------------------------------------------------------------------------
# Log-rank tests
# ---------------------------------------------------------------------------

def _group_values(cohort: DataFrame, group_col: str) -> list:
    vals = [r[0] for r in cohort.where(F.col(group_col).isNotNull())
            .select(group_col).distinct().collect()]
    return sorted(vals)


def logrank_wide(cohort: DataFrame, group_col: str, levels: Sequence, *,
                 time_col: str = "duration", event_col: str = "event") -> DataFrame:
    """Per pooled time: at-risk and deaths of every group as columns ``n_i, d_i``.

    A group with no row at some time still gets its risk count there (scan over the pooled
    time axis). ``levels`` is the known, small list of group values.
    """
    keep = F.col(time_col).isNotNull() & F.col(group_col).isin(list(levels))
    idx = F.coalesce(*[F.when(F.col(group_col) == F.lit(v), F.lit(i)) for i, v in enumerate(levels)])
    k = len(levels)
    aggs = []
    for i in range(k):
        mine = idx == i
        aggs.append(F.sum(mine.cast("long")).alias(f"t_{i}"))
        aggs.append(F.sum((mine & (F.col(event_col) > 0)).cast("long")).alias(f"d_{i}"))
    per_time = (cohort.where(keep).groupBy(F.col(time_col).cast("double").alias("time"))
                .agg(*aggs))
    scanned = prefix_scan(per_time, [], "time", {f"n_{i}": f"t_{i}" for i in range(k)},
                          descending=True)
    return scanned.select("time", *[f"n_{i}" for i in range(k)], *[f"d_{i}" for i in range(k)])


def logrank_test(cohort: DataFrame, group_col: str, *, time_col: str = "duration",
                 event_col: str = "event") -> dict:
    """NP-11: k-sample log-rank, ``chi2 = Z' V^- Z`` with k-1 degrees of freedom.

    One Spark job returns the k-vector O-E and the k x k hypergeometric covariance; the
    driver only inverts that small matrix.
    """
    levels = _group_values(cohort, group_col)
    k = len(levels)
    if k < 2:
        return {"test_statistic": 0.0, "p_value": 1.0, "df": 0, "levels": levels}
    wide = logrank_wide(cohort, group_col, levels, time_col=time_col, event_col=event_col)
    n = sum(F.col(f"n_{i}") for i in range(k)).cast("double")
    d = sum(F.col(f"d_{i}") for i in range(k)).cast("double")
    vf = F.when(n > 1, d * (n - d) / (n - 1)).otherwise(F.lit(0.0))
    aggs = []
    for i in range(k):
        ni = F.col(f"n_{i}").cast("double")
        aggs.append(F.sum(F.col(f"d_{i}") - F.when(n > 0, d * ni / n).otherwise(0.0)).alias(f"z_{i}"))
        for j in range(i, k):
            nj = F.col(f"n_{j}").cast("double")
            term = (vf * ni / n * ((F.lit(1.0) if i == j else F.lit(0.0)) - nj / n))
            aggs.append(F.sum(F.when(n > 0, term).otherwise(0.0)).alias(f"v_{i}_{j}"))
    row = wide.agg(*aggs).collect()[0]
    zvec = np.array([row[f"z_{i}"] for i in range(k)], dtype=float)
    vmat = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            vmat[i, j] = vmat[j, i] = row[f"v_{i}_{j}"]
    zr, vr = zvec[: k - 1], vmat[: k - 1, : k - 1]
    stat = float(zr @ np.linalg.pinv(vr) @ zr)
    return {"test_statistic": stat, "p_value": chi2_sf(stat, k - 1), "df": k - 1,
            "levels": levels, "observed_minus_expected": zvec.tolist()}


def logrank_summary(cohort: DataFrame, group_cols: Sequence[str], **kw) -> DataFrame:
    """NP-12: one row per grouping column: ``subgroup, test_statistic, p_value, significant``."""
    rows = []
    for gc in group_cols:
        res = logrank_test(cohort, gc, **kw)
        rows.append((gc, float(res["test_statistic"]), float(res["p_value"]),
                     bool(res["p_value"] < 0.05)))
    return cohort.sparkSession.createDataFrame(
        rows, "subgroup string, test_statistic double, p_value double, significant boolean")


def pairwise_logrank_stats(cohort: DataFrame, group_col: str, *, time_col: str = "duration",
                           event_col: str = "event", levels: Sequence | None = None) -> DataFrame:
    """NP-13 (statistics): all pairs a < b in one job over the pooled per-time table."""
    levels = levels if levels is not None else _group_values(cohort, group_col)
    wide = logrank_wide(cohort, group_col, levels, time_col=time_col, event_col=event_col)
    pairs = list(combinations(range(len(levels)), 2))
    if not pairs:
        spark = cohort.sparkSession
        return spark.createDataFrame(
            [], "group_a string, group_b string, o_minus_e double, variance double, test_statistic double")
    structs = [F.struct(F.lit(str(levels[a])).alias("a"), F.lit(str(levels[b])).alias("b"),
                        F.col(f"n_{a}").alias("na"), F.col(f"d_{a}").alias("da"),
                        F.col(f"n_{b}").alias("nb"), F.col(f"d_{b}").alias("db"))
               for a, b in pairs]
    long = wide.select(F.inline(F.array(*structs)))
    n = (F.col("na") + F.col("nb")).cast("double")
    d = (F.col("da") + F.col("db")).cast("double")
    na = F.col("na").cast("double")
    live = n > 0
    e_a = F.when(live, d * na / n).otherwise(0.0)
    v = F.when(n > 1, d * (n - d) / (n - 1) * (na / n) * (F.lit(1.0) - na / n)).otherwise(0.0)
    agg = long.groupBy("a", "b").agg(F.sum(F.col("da").cast("double") - e_a).alias("o_minus_e"),
                                     F.sum(v).alias("variance"))
    return agg.select(F.col("a").alias("group_a"), F.col("b").alias("group_b"), "o_minus_e",
                      "variance",
                      F.when(F.col("variance") > 0,
                             F.col("o_minus_e") * F.col("o_minus_e") / F.col("variance"))
                      .otherwise(F.lit(0.0)).alias("test_statistic"))


def pairwise_logrank(cohort: DataFrame, group_col: str, **kw) -> DataFrame:
    """NP-13: ``group_a, group_b, test_statistic, p_value, significant`` (1 df each)."""
    stats = pairwise_logrank_stats(cohort, group_col, **kw)
    p = chi2_sf_col1(F.col("test_statistic"))
    return stats.select("*", p.alias("p_value")).withColumn("significant", F.col("p_value") < 0.05)
