"""Normalisers for clinical cohort tables (SRC-1, SRC-2) read with Spark's own readers (SRC-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardflow.functions.columns import grade_code, status_event
from hazardflow.operators.prep import fit_scaler


def read_cohort(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """SRC-5: parquet/CSV/JSON cohort with an explicit schema when given (no inference at scale)."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def normalise_status_cohort(raw: DataFrame, *, time_col: str = "time", status_col: str = "status",
                            dead_code: int = 2, drop=("inst",), impute: bool = True) -> DataFrame:
    """SRC-1: ``event = status == dead``, ``time -> duration``, dotted names to underscores,
    numeric columns as double, medians filled into non-outcome columns."""
    df = raw
    for c in df.columns:
        if "." in c:
            df = df.withColumnRenamed(c, c.replace(".", "_"))
    df = df.withColumn("event", status_event(F.col(status_col), dead_code)).withColumnRenamed(
        time_col, "duration").drop(status_col, *[d for d in drop if d in df.columns])
    feats = [c for c, t in df.dtypes if c not in ("duration", "event") and t in
             ("int", "bigint", "double", "float", "smallint")]
    df = df.select(F.col("duration").cast("double"), F.col("event").cast("int"),
                   *[F.col(c).cast("double") for c in feats],
                   *[F.col(c) for c in df.columns if c not in feats and c not in ("duration", "event")])
    if impute and feats:
        df = fit_scaler(df, feats).impute(df)
    return df


def normalise_coded_cohort(raw: DataFrame, *, time_col: str = "time", event_col: str = "cens") -> DataFrame:
    """SRC-2: ``horTh == 'yes'``, ``menostat == 'Post'``, grade I/II/III -> 1/2/3 (else 2)."""
    df = raw.withColumnRenamed(time_col, "duration").withColumnRenamed(event_col, "event")
    if "horTh" in df.columns:
        df = df.withColumn("horTh", (F.col("horTh") == "yes").cast("int"))
    if "menostat" in df.columns:
        df = df.withColumn("menostat", (F.col("menostat") == "Post").cast("int"))
    if "tgrade" in df.columns:
        df = df.withColumn("tgrade", grade_code(F.col("tgrade")))
    return df.withColumn("duration", F.col("duration").cast("double")).withColumn(
        "event", F.col("event").cast("int"))
