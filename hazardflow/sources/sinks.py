"""Sinks: result tables (SINK-1) and an append-only model registry (SINK-2)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY_SCHEMA = "seq long, name string, c_index double, dataset string, make_active boolean"


def save_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> str:
    """SINK-1: write a result table (CSV with header by default; parquet on request)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def register_model(spark: SparkSession, path: str, name: str, c_index: float | None, dataset: str,
                   make_active: bool = False) -> None:
    """Append one registry row; ``seq`` continues the table's sequence."""
    try:
        seq = spark.read.parquet(path).agg(F.max("seq")).collect()[0][0]
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        seq = None  # first registration: no table yet
    row = [((seq or 0) + 1, name, c_index, dataset, bool(make_active))]
    spark.createDataFrame(row, REGISTRY_SCHEMA).write.mode("append").parquet(path)


def list_models(registry: DataFrame) -> DataFrame:
    """Rows with a derived ``is_active``: the latest ``make_active`` row, else the first one.

    Writers that took the same ``seq`` are told apart by name and dataset, so exactly one is active
    (equal rows count as one registration).
    """
    at = F.struct("seq", "name", "dataset")
    pick = registry.agg(F.coalesce(F.max(F.when(F.col("make_active"), at)), F.min(at)).alias("_active"))
    rows = registry.dropDuplicates(["seq", "name", "dataset", "c_index", "make_active"])
    return rows.join(pick, at == F.col("_active"), "left").select(
        "name", "c_index", "dataset", F.col("_active").isNotNull().alias("is_active"), "seq").orderBy("seq", "name")
