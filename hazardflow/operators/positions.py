"""Dense positions of rows in a total order, and running sums over them in blocks of equal size.

A range shuffle sorts the rows; a row's position is its place in its partition plus the sizes of the
partitions before it. The sorted rows are checkpointed with both numbers, so positions never change when a
task is repeated. Rows must differ in their order columns: then no partition can be much larger than
another, whatever values are hot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardflow.session import cut_lineage

BLOCK_ROWS = 1 << 15


def with_position(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with the position (from 0) of each row by the columns ``order``, which tell all rows apart."""
    placed = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = {r["p"]: r["n"] for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, rows = 0, []
    for p in sorted(sizes):  # one number a partition
        rows.append((p, before))
        before += sizes[p]
    starts = F.broadcast(df.sparkSession.createDataFrame(rows, "_part long, _start long"))
    return placed.join(starts, part == F.col("_part")).select(
        *df.columns, (F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).alias(name))


def running(df: DataFrame, pos: str, sums: Mapping[str, Column | str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Adds inclusive running sums over all rows by position; a task holds ``block_rows`` of them."""
    sums = {k: F.col(v) if isinstance(v, str) else v for k, v in sums.items()}
    block = F.expr(f"{pos} div {int(block_rows)}")
    base = df.select("*", block.alias("_blk"), *[c.alias(f"_in_{k}") for k, c in sums.items()])
    before = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)  # one row a block
    offsets = base.groupBy("_blk").agg(*[F.sum(f"_in_{k}").alias(f"_t_{k}") for k in sums]).select(
        F.col("_blk").alias("_b"), *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_off_{k}") for k in sums])
    inside = Window.partitionBy("_blk").orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = base.join(offsets, F.col("_blk") == F.col("_b"))
    return joined.select(*df.columns, *[(F.sum(f"_in_{k}").over(inside) + F.col(f"_off_{k}")).alias(k) for k in sums])
