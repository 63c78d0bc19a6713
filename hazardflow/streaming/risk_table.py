"""STRM-2: risk table kept current as subjects arrive; curves recomputed from the state.

The streaming aggregate holds one row per (group, time) – bounded by distinct times, not by
subjects. Each micro-batch hands the complete count table to ``foreachBatch``, which runs the
same distributed scans as the batch path and writes the curve table to the sink.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardflow.operators.nonparam import km_curve
from hazardflow.operators.scan import prefix_scan


def stream_counts(stream: DataFrame, group_cols: Sequence[str] = (), *, time_col: str = "duration",
                  event_col: str = "event") -> DataFrame:
    g = list(group_cols)
    keep = F.col(time_col).isNotNull() & ~F.isnan(F.col(time_col).cast("double")) & F.col(event_col).isNotNull()
    for c in g:
        keep = keep & F.col(c).isNotNull()
    return (stream.where(keep)
            .groupBy(*g, F.col(time_col).cast("double").alias("time"))
            .agg(F.count(F.lit(1)).alias("n_total"),
                 F.sum((F.col(event_col) > 0).cast("long")).alias("d")))


def risk_table_from_counts(counts: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    g = list(group_cols)
    sc = prefix_scan(counts, g, "time", {"n_at_risk": "n_total"}, descending=True)
    return sc.select(*g, "time", "n_at_risk", "d", (F.col("n_total") - F.col("d")).alias("c"),
                     "n_total")


def curve_writer(group_cols: Sequence[str], sink: Callable[[DataFrame, int], None]):
    """``foreachBatch`` function: complete counts -> KM curve -> ``sink(curve, epoch)``."""
    g = list(group_cols)

    def write(batch: DataFrame, epoch: int) -> None:
        rt = risk_table_from_counts(batch, g)
        sink(km_curve(None, g, table=rt), epoch)

    return write


def start_incremental_km(stream: DataFrame, group_cols: Sequence[str], sink, *, checkpoint: str,
                         time_col: str = "duration", event_col: str = "event", trigger=None):
    counts = stream_counts(stream, group_cols, time_col=time_col, event_col=event_col)
    w = (counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
         .foreachBatch(curve_writer(group_cols, sink)))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
