"""Report tables that feed plots and dashboards (RPT-*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardflow.operators.quantiles import exact_percentiles


def cohort_overview(cohort: DataFrame, *, time_col: str = "duration", event_col: str = "event") -> DataFrame:
    """RPT-1: ``n, events, event_rate, median_followup`` (exact interpolated median)."""
    med = exact_percentiles(cohort, time_col, [0.5]).collect()
    median = med[0]["value"] if med else None
    stats = cohort.agg(F.count(F.lit(1)).alias("n"),
                       F.sum((F.col(event_col) > 0).cast("long")).alias("events"))
    return stats.select(
        "n", "events",
        F.when(F.col("n") > 0, F.col("events") / F.col("n")).alias("event_rate"),
        F.lit(median).cast("double").alias("median_followup"))


def duration_histogram(cohort: DataFrame, *, time_col: str = "duration", n_bins: int = 40) -> DataFrame:
    """RPT-2: equal-width bins from min to max (last bin closed), empty bins included."""
    lo, hi = cohort.agg(F.min(time_col), F.max(time_col)).collect()[0]
    spark = cohort.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, n long")
    width = (hi - lo) / n_bins if hi > lo else 0.0
    if width > 0:
        b = F.least(F.lit(n_bins - 1),
                    F.floor((F.col(time_col) - F.lit(lo)) * F.lit(float(n_bins)) / F.lit(hi - lo))
                    .cast("int"))
    else:
        b = F.lit(0)
    counts = cohort.where(F.col(time_col).isNotNull()).groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    bins = spark.range(n_bins).select(F.col("id").cast("int").alias("bin"))
    return bins.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"),
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """RPT-3: per column ``count, mean, std (sample), min, q25, q50, q75, max``."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                      for c in columns])
    long = df.select(F.inline(pairs)).where(F.col("value").isNotNull())
    basic = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    q = exact_percentiles(long, "value", [0.25, 0.5, 0.75], ["column"], small_groups=True)
    qw = q.groupBy("column").agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(name)
                                   for p, name in [(0.25, "q25"), (0.5, "q50"), (0.75, "q75")]])
    return basic.join(qw, "column").select("column", "count", "mean", "std", "min", "q25", "q50",
                                           "q75", "max")
