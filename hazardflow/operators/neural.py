"""Kernels of the neural survival models as DataFrame aggregates (NN-1, 4, 5, 6, 8, 10).

The training loops themselves (NN-2/7) are data-parallel gradient rounds; the losses here are
what each round aggregates, written so that no pair of subjects is ever materialised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardflow.operators.scan import prefix_scan


def cox_loss(df: DataFrame, *, score_col: str = "score", time_col: str = "duration",
             event_col: str = "event") -> float:
    """NN-1: mean over events of ``log sum_{T_j >= T_i} exp(s_j) - s_i`` (ties share the full set).

    Scores are shifted by their maximum first; risk sets come from a descending scan per time.
    """
    smax = df.agg(F.max(score_col)).collect()[0][0]
    if smax is None:
        return float("nan")
    per = df.groupBy(F.col(time_col).cast("double").alias("time")).agg(
        F.sum(F.exp(F.col(score_col) - F.lit(smax))).alias("w"),
        F.sum((F.col(event_col) > 0).cast("long")).alias("d"),
        F.sum(F.when(F.col(event_col) > 0, F.col(score_col)).otherwise(F.lit(0.0))).alias("s_ev"))
    sc = prefix_scan(per, [], "time", {"risk": "w"}, descending=True)
    row = sc.agg(F.sum(F.col("d") * (F.log(F.col("risk")) + F.lit(smax)) - F.col("s_ev")).alias("num"),
                 F.sum("d").alias("den")).collect()[0]
    return float(row["num"] / row["den"]) if row["den"] else float("nan")


def discretise(df: DataFrame, n_bins: int, *, time_col: str = "duration", out_col: str = "bin") -> DataFrame:
    """NN-4: equal-width bins from min to max + 1e-6, ``least(floor((t - min) / w), n_bins - 1)``."""
    lo, hi = df.agg(F.min(time_col), F.max(time_col)).collect()[0]
    width = ((hi + 1e-6) - lo) / n_bins
    b = F.least(F.floor((F.col(time_col) - F.lit(lo)) / F.lit(width)), F.lit(n_bins - 1)).cast("int")
    return df.withColumn(out_col, b)


def survival_from_pmf(pmf: Column, b: Column) -> Column:
    """NN-8: ``S`` at the start of bin b = 1 - sum_{s<b} pmf[s] (bins 0-based), clipped to [0, 1]."""
    acc = F.aggregate(F.slice(pmf, 1, F.greatest(b, F.lit(0))), F.lit(0.0), lambda a, x: a + x)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(1.0) - F.when(b > 0, acc).otherwise(0.0)))


def deephit_nll(df: DataFrame, *, pmf_col: str = "pmf", cause_col: str = "cause", bin_col: str = "bin") -> float:
    """NN-5: ``-mean log max(P(cause, bin), 1e-8)`` over subjects with an event.

    ``pmf`` is ``array<array<double>>`` indexed [cause-1][bin].
    """
    p = F.element_at(F.element_at(F.col(pmf_col), F.col(cause_col)), F.col(bin_col) + 1)
    row = df.where(F.col(cause_col) > 0).agg(F.avg(-F.log(F.greatest(p, F.lit(1e-8))))).collect()[0]
    return float(row[0]) if row[0] is not None else float("nan")


def deephit_rank_loss(df: DataFrame, n_bins: int, *, sigma: float = 0.1, pmf_col: str = "pmf",
                      cause_col: str = "cause", bin_col: str = "bin", cause: int = 1) -> float:
    """NN-6: ``mean_{i event of cause, j: bin_j > bin_i} exp(-(F_i(b_i) - F_j(b_i)) / sigma)``.

    The kernel is separable: ``exp(-F_i/s) * exp(F_j/s)`` at the bin of i; per bin b one factor is
    summed over events in b and the other over subjects with a later bin, so there is no pair join:
    every subject emits its CIF at every bin (n x bins rows), then one aggregate per bin.
    """
    cif = F.transform(F.sequence(F.lit(0), F.lit(n_bins - 1)), lambda b: F.aggregate(
        F.slice(F.element_at(F.col(pmf_col), F.lit(cause)), 1, b + 1), F.lit(0.0), lambda a, x: a + x))
    rows = df.select(F.col(bin_col).alias("bi"), (F.col(cause_col) == cause).alias("is_ev"),
                     F.posexplode(cif).alias("b", "F"))
    ev_here = F.col("is_ev") & (F.col("bi") == F.col("b"))
    later = F.col("bi") > F.col("b")
    per_bin = rows.groupBy("b").agg(
        F.sum(F.when(ev_here, F.exp(-F.col("F") / F.lit(sigma))).otherwise(0.0)).alias("a"),
        F.sum(F.when(ev_here, F.lit(1)).otherwise(F.lit(0))).alias("n_ev"),
        F.sum(F.when(later, F.exp(F.col("F") / F.lit(sigma))).otherwise(0.0)).alias("c"),
        F.sum(F.when(later, F.lit(1)).otherwise(F.lit(0))).alias("n_later"))
    tot = per_bin.agg(F.sum(F.col("a") * F.col("c")).alias("num"),
                      F.sum(F.col("n_ev") * F.col("n_later")).alias("den")).collect()[0]
    return float(tot["num"] / tot["den"]) if tot["den"] else 0.0


def exponential_curve(df: DataFrame, times, *, risk_col: str = "risk", time_col: str = "duration",
                      id_col: str = "subject_id") -> DataFrame:
    """NN-10: ``S(t) = exp(-exp(r - mean r) * t / mean T)`` at a few times, long output."""
    mr, mt = df.agg(F.avg(risk_col), F.avg(time_col)).collect()[0]
    rows = F.array(*[F.struct(F.lit(float(t)).alias("time"),
                              F.exp(-F.exp(F.col(risk_col) - F.lit(mr)) * F.lit(float(t)) / F.lit(mt))
                              .alias("survival")) for t in times])
    return df.select(id_col, F.inline(rows))
