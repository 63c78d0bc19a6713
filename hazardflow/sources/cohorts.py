"""Time-to-event cohorts derived from the warehouse tables.

Every cohort has the columns ``subject_id long, grp string, duration double`` plus ``event int``
(0 censored / 1 event) or ``cause int`` (0 censored / 1..K causes) and numeric covariates ``x1..``.
Durations follow SRC-3: time to the event, or to the administrative end when none is seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardflow.operators.scan import bucketed_lead
from hazardflow.session import read_table

# Fixed values of the derived cohorts (administrative censoring dates).
REORDER_END = "2001-08-02"
GAP_END = "2024-01-31 00:00:00"


def _micros_ntz(col: Column) -> Column:
    """Wall-clock microseconds since 1970 of a TIMESTAMP_NTZ, independent of the session zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, col.cast("timestamp_ntz"))


def time_to_event(start: Column, event_at: Column, censor_at: Column, *, unit_days: bool = True,
                  floor: float | None = 1.0, cap: float | None = None) -> tuple[Column, Column]:
    """SRC-3: ``duration = least(event, censor) - start``, ``event = event <= censor``, clipped.

    ``event_at`` may be NULL (no event seen). Returns (duration, event) columns.
    """
    observed = event_at.isNotNull() & (event_at <= censor_at)
    end = F.when(observed, event_at).otherwise(censor_at)
    if unit_days:
        dur = F.datediff(end.cast("date"), start.cast("date")).cast("double")
    else:
        dur = (_micros_ntz(end) - _micros_ntz(start)).cast("double") / F.lit(3.6e9)
    if floor is not None:
        dur = F.greatest(F.lit(float(floor)), dur)
    if cap is not None:
        dur = F.least(F.lit(float(cap)), dur)
    return dur, observed.cast("int")


def reorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: days until the same customer's next order (censored at the end date)."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    orders = orders.withColumn("_od", _micros_ntz(F.col("o_orderdate")).cast("double"))
    nxt = bucketed_lead(orders, ["o_custkey"], "_od", "o_orderkey", {"next_date": "o_orderdate"})
    dur, ev = time_to_event(F.col("o_orderdate"), F.col("next_date"),
                            F.lit(REORDER_END).cast("timestamp_ntz"))
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return (
        nxt.join(cust, nxt.o_custkey == cust.c_custkey, "inner")
        .select(
            F.col("o_orderkey").cast("long").alias("subject_id"),
            F.col("o_orderpriority").alias("grp"),
            dur.alias("duration"),
            ev.alias("event"),
            F.col("o_totalprice").cast("double").alias("x1"),
            F.col("c_acctbal").cast("double").alias("x2"),
        )
    )


def gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event: hours to the user's next event; cause 1 = purchase next, 2 = error next."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    ev = ev.withColumn("_ts", _micros_ntz(F.col("ts")).cast("double"))
    nxt = bucketed_lead(ev, ["user_id"], "_ts", "event_id", {"next_ts": "ts", "next_type": "event_type"})
    dur, seen = time_to_event(F.col("ts"), F.col("next_ts"), F.lit(GAP_END).cast("timestamp_ntz"),
                              unit_days=False, floor=None)
    cause = (F.when(seen == 0, 0)
             .when(F.col("next_type") == "purchase", 1)
             .when(F.col("next_type") == "error", 2)
             .otherwise(0))
    return nxt.select(
        F.col("event_id").cast("long").alias("subject_id"),
        F.col("event_type").alias("grp"),
        dur.alias("duration"),
        cause.cast("int").alias("cause"),
        F.col("value").cast("double").alias("x1"),
    )


def custlife(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer: days from first order to first fulfilled ('F') order, censored at last order."""
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderstatus")
    per = orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_at"),
        F.min(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))).alias("f_at"),
        F.max("o_orderdate").alias("last_at"),
    )
    dur, ev = time_to_event(F.col("first_at"), F.col("f_at"), F.col("last_at"))
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return per.join(cust, per.o_custkey == cust.c_custkey, "inner").select(
        F.col("c_custkey").cast("long").alias("subject_id"),
        F.col("c_mktsegment").alias("grp"),
        dur.alias("duration"),
        # ties of F-date and last date count as events, as the definition reads
        F.col("f_at").isNotNull().cast("int").alias("event"),
        F.col("c_acctbal").cast("double").alias("x1"),
    )


def lineqty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extreme-tie cohort: quantity as duration, returned ('R') as event."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus",
        "l_extendedprice", "l_discount")
    return li.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).cast("long").alias("subject_id"),
        F.col("l_linestatus").alias("grp"),
        F.col("l_quantity").cast("double").alias("duration"),
        (F.col("l_returnflag") == "R").cast("int").alias("event"),
        F.col("l_extendedprice").cast("double").alias("x1"),
        F.col("l_discount").cast("double").alias("x2"),
    )


COHORTS = {"reorder": reorder, "gap": gap, "custlife": custlife, "lineqty": lineqty}


def load_cohort(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    """SRC-5 dispatcher: a named cohort; unknown names are an error."""
    try:
        build = COHORTS[name]
    except KeyError:
        raise ValueError(f"Unknown cohort {name!r}; choose one of {sorted(COHORTS)}") from None
    return build(spark, sf_dir)
