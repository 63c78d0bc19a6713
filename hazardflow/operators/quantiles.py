"""Exact percentiles (linear interpolation between closest ranks) from a distributed scan.

``percentile``/``median`` keep every distinct value of a group in one aggregation buffer; here
values are counted per distinct value, ranked by the bucketed prefix scan, and each requested
rank is picked by a conditional ``min`` – memory per task stays bounded however large a group is.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardflow.operators.scan import null_safe_join, prefix_scan


def exact_percentiles(df: DataFrame, value_col: str, probs: Sequence[float], group_cols=(),
                      *, small_groups: bool = False) -> DataFrame:
    """One row per (groups, p): ``p, value`` with numpy/DuckDB ``quantile_cont`` semantics."""
    g = list(group_cols)
    cnt = (df.where(F.col(value_col).isNotNull() & ~F.isnan(F.col(value_col)))
           .groupBy(*g, F.col(value_col).cast("double").alias("_v"))
           .agg(F.count(F.lit(1)).alias("_c")))
    sc = prefix_scan(cnt, g, "_v", {"_cum": "_c"})
    if g:
        sc = null_safe_join(sc, cnt.groupBy(*g).agg(F.sum("_c").alias("_n")), g, "inner")
        n = F.col("_n")
    else:
        total = cnt.agg(F.sum("_c")).collect()[0][0] or 0
        n = F.lit(int(total))
    aggs = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (n - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs.append(F.min(F.when(F.col("_cum") > lo, F.col("_v"))).alias(f"_lo{i}"))
        aggs.append(F.min(F.when(F.col("_cum") > hi, F.col("_v"))).alias(f"_hi{i}"))
        aggs.append(F.first(pos - lo).alias(f"_fr{i}"))
    wide = sc.groupBy(*g).agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(float(p)).alias("p"),
                 (F.col(f"_lo{i}") + F.col(f"_fr{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}")))
                 .alias("value"))
        for i, p in enumerate(probs)])
    return wide.select(*g, F.inline(rows))


def exact_median(df: DataFrame, value_col: str, group_cols=(), **kw) -> DataFrame:
    out = exact_percentiles(df, value_col, [0.5], group_cols, **kw)
    return out.select(*list(group_cols), F.col("value").alias("median"))


def percentile_edges(df: DataFrame, value_col: str, n_bins: int) -> list[float]:
    """Bin edges at ``linspace(0, 100, n_bins + 1)`` percentiles, duplicates removed (EV-6)."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    got = exact_percentiles(df, value_col, probs).orderBy("p").collect()
    edges = [r["value"] for r in got if r["value"] is not None and not math.isnan(r["value"])]
    return sorted(set(edges))
