"""Connected components of an edge table: alternating large-star and small-star steps as Spark joins.

No node's neighbours are gathered anywhere: a step takes every node's least neighbour by a partially
aggregated minimum and joins it back to the edges (Spark can split a hub's join partition). Every step is
checkpointed, so a lost executor costs one step at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

TASK_EDGES = 20_000


def _least(directed: DataFrame) -> DataFrame:
    return directed.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (u, v): the label is the least node of its component."""
    now = cut_lineage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(now)
    while True:
        rows = now.coalesce(1 + state[0] // TASK_EDGES)  # few tasks for few edges; more edges keep their partitions
        now = cut_lineage(_small_star(_large_star(rows)).where("u <> v").distinct())
        after = _state(now)
        if after == state:
            break
        state = after
    labels = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct())
