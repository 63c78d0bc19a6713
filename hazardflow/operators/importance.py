"""Permutation importance (EV-9, RSF-6, RSF-7): the concordance lost when one feature's values change owners.

A permutation pairs the subject of rank k by id with the value of rank k by a seeded hash of the id (leading
hex digits of an MD5, which any SQL engine can repeat). All permutations of all features are scored and
compared in one keyed run: the number of jobs depends on neither features nor repeats.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardflow.functions.columns import repeatable_hash
from hazardflow.operators.concordance import concordance_by
from hazardflow.operators.positions import with_position

BASE = ""


def donors(df: DataFrame, *, id_col: str = "subject_id", seed: int = 42, repeats: int = 1) -> DataFrame:
    """(id, repeat, donor): from whom each subject (unique id) gets its value in each permutation."""
    ids = with_position(df.select(F.col(id_col).alias("_id")), ["_id"], "_k")
    drawn = df.select(F.col(id_col).alias("_donor"), F.explode(F.array(*[
        F.struct(F.lit(r).alias("repeat"), repeatable_hash(F.col(id_col), f"{seed}:{r}").alias("h")) for r in range(repeats)])).alias("d"))
    drawn = drawn.select("_donor", F.col("d.repeat").alias("_repeat"), F.col("d.h").alias("_h"))
    drawn = with_position(drawn, ["_repeat", "_h", "_donor"], "_pos")
    n = ids.count()
    rank = (F.col("_pos") - F.col("_repeat") * F.lit(n)).alias("_k")  # every repeat deals all subjects
    return ids.join(drawn.select("_repeat", "_donor", rank), "_k").select("_id", "_repeat", "_donor")


def permuted(df: DataFrame, features: Sequence[str], *, id_col: str = "subject_id", seed: int = 42, repeats: int = 1) -> DataFrame:
    """``df`` once for each feature and repeat (columns ``_feature``, ``_repeat``), that feature's values dealt anew."""
    deal = donors(df, id_col=id_col, seed=seed, repeats=repeats)
    values = df.select(F.col(id_col).alias("_donor"), F.struct(*features).alias("_new"))
    both = df.join(deal, F.col(id_col) == F.col("_id")).join(values, "_donor")
    copies = both.select("*", F.explode(F.array(*[F.lit(f) for f in features])).alias("_feature"))
    return copies.select(*[F.when(F.col("_feature") == c, F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in features else F.col(c)
                           for c in df.columns], "_feature", "_repeat")


def permutation_importance(df: DataFrame, features: Sequence[str], risk_of: Callable[[DataFrame], Column] | None = None, *,
                           scorer=None, id_col: str = "subject_id", time_col: str = "duration", event_col: str = "event",
                           repeats: int = 5, seed: int = 42) -> DataFrame:
    """(feature, baseline, importance, importance_std, repeats), most important first.

    Importance is the mean loss of the C-index over the repeats, its deviation the population one. The risk
    comes from ``risk_of`` (a column of a frame) or from a ``scorer`` (see ``plans.scorers``).
    """
    data = df if scorer is None else df.select(*dict.fromkeys([id_col, time_col, event_col, *features, *scorer.features]))
    base = data.withColumn("_feature", F.lit(BASE)).withColumn("_repeat", F.lit(0))
    rows = base.unionByName(permuted(data, features, id_col=id_col, seed=seed, repeats=repeats))
    if scorer is None:
        rows = rows.withColumn("_risk", risk_of(rows))
    else:
        names = ["_feature", "_repeat", id_col]
        rows = rows.select(*names, time_col, event_col).join(
            scorer.risk(rows, names).withColumnRenamed("risk", "_risk"), names)
    c = concordance_by(rows, ["_feature", "_repeat"], time_col=time_col, event_col=event_col, risk_col="_risk")
    first = F.broadcast(c.where(F.col("_feature") == BASE).select(F.col("c_index").alias("baseline")))  # one row
    lost = c.where(F.col("_feature") != BASE).join(first, F.lit(True)).withColumn("_lost", F.col("baseline") - F.col("c_index"))
    return lost.groupBy(F.col("_feature").alias("feature"), "baseline").agg(
        F.avg("_lost").alias("importance"), F.stddev_pop("_lost").alias("importance_std"),
        F.count(F.lit(1)).cast("int").alias("repeats")).orderBy(F.desc("importance"), "feature")


def normalised(importance: DataFrame) -> DataFrame:
    """RSF-6: negative importances count as 0, and the rest add up to 1 (all 0 if none is positive)."""
    clipped = importance.withColumn("_i", F.greatest(F.col("importance"), F.lit(0.0)))
    total = F.broadcast(clipped.agg(F.sum("_i").alias("_sum")))
    share = F.when(F.col("_sum") > 0, F.col("_i") / F.col("_sum")).otherwise(F.lit(0.0))
    return clipped.join(total, F.lit(True)).select("feature", share.alias("importance")).orderBy(F.desc("importance"), "feature")
