"""Corpus pipeline: five stages over ``documents``, each a DataFrame that is written and read by the next.

quality classifier (rejected documents go), line dedup (later repeats of three-line windows are cut out of
the texts), near-duplicate classes (one document of each stays), benchmark decontamination (documents that
hold a benchmark window go), mixing to target weights (one row a selected document and epoch).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardflow.llm.decontaminate import drop_contaminated
from hazardflow.llm.line_dedup import drop_repeated_lines
from hazardflow.llm.mixing import mix_documents
from hazardflow.llm.near_dedup import drop_near_duplicates
from hazardflow.llm.quality import drop_poor
from hazardflow.llm.tables import written
from hazardflow.session import prepare

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return drop_poor(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return drop_repeated_lines(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mix_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: SQL can't express the classifier's model; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
