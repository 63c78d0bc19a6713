"""Model evaluation rows and comparison tables (EV-7, EV-10, EV-11; RPT-6, RPT-7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardflow.operators.concordance import concordance
from hazardflow.operators.metrics import brier_scores, crude_brier, time_auc

CLINICAL_TIMES = [30.0, 90.0, 180.0, 365.0]
FULL_COLUMNS = ["model", "c_index", "dataset"]


def evaluate_model(model_name: str, dataset: str, train: DataFrame, test: DataFrame, risk: DataFrame,
                   predictions: DataFrame, times: Sequence[float] = CLINICAL_TIMES, *,
                   id_col: str = "subject_id") -> DataFrame:
    """EV-7: one row ``model, dataset, c_index, ibs, auc_{t}d`` rounded to 4; missing -> NaN."""
    spark = test.sparkSession
    scored = test.join(risk.select(id_col, F.col("risk").alias("_risk")), id_col)
    c = concordance(scored, risk_col="_risk")["c_index"]
    bs = {(r["metric"], r["time"]): r["value"] for r in brier_scores(train, test, predictions, times).collect()}
    auc = {r["time"]: r["auc"] for r in time_auc(train, test, risk, times).collect()}
    nan = float("nan")

    def r4(v):
        return round(float(v), 4) if v is not None else nan

    row = [model_name, dataset, r4(c), r4(bs.get(("ibs", None)))]
    row += [r4(auc.get(float(t))) for t in times]
    cols = ["model", "dataset", "c_index", "ibs"] + [f"auc_{int(t)}d" for t in times]
    return spark.createDataFrame([tuple(row)], cols)


def crude_table(models: Sequence[tuple[str, str, DataFrame, DataFrame | None]], test: DataFrame,
                times: Sequence[float] = CLINICAL_TIMES, *, id_col: str = "subject_id") -> DataFrame:
    """EV-8 as a table: ``model, c_index, brier_{t}d.., dataset``, rounded to 4 places.

    ``models`` are (model, dataset, risk (id, risk), predictions or None); without predictions the
    Brier columns are NULL.
    """
    rows = []
    for name, dataset, risk, predictions in models:
        scored = test.join(risk.select(id_col, F.col("risk").alias("_risk")), id_col)
        c = concordance(scored, risk_col="_risk")["c_index"]
        brier = {} if predictions is None else {
            r["time"]: r["brier"] for r in crude_brier(test, predictions, times, id_col=id_col).collect()}
        scores = [None if brier.get(float(t)) is None else round(float(brier[float(t)]), 4) for t in times]
        rows.append((name, round(float(c), 4), *scores, dataset))
    columns = ", ".join(f"brier_{int(t)}d double" for t in times)
    return test.sparkSession.createDataFrame(rows, f"model string, c_index double, {columns}, dataset string")


def comparison_table(rows: DataFrame) -> DataFrame:
    """EV-10: ordered by dataset ascending, C-index descending."""
    return rows.orderBy(F.col("dataset").asc(), F.col("c_index").desc())


def full_comparison(classical: DataFrame, deep: DataFrame, default_dataset: str = "icu") -> DataFrame:
    """EV-11: stack both result tables, missing columns NULL; model, c_index and dataset come first."""
    both = classical.unionByName(deep, allowMissingColumns=True)
    if "dataset" in both.columns:
        both = both.withColumn("dataset", F.coalesce(F.col("dataset"), F.lit(default_dataset)))
    first = [c for c in FULL_COLUMNS if c in both.columns]
    return both.select(*first, *[c for c in both.columns if c not in first])


def cindex_pivot(rows: DataFrame, datasets: Sequence[str]) -> DataFrame:
    """RPT-7: per model a C-index column for each dataset and ``best_<dataset>``, true for its best models."""
    best = rows.groupBy("dataset").agg(F.max("c_index").alias("_best"))
    flagged = rows.join(best, "dataset").withColumn("_is_best", F.col("c_index") == F.col("_best"))
    return flagged.groupBy("model").agg(
        *[F.first(F.when(F.col("dataset") == d, F.col("c_index")), ignorenulls=True).alias(d) for d in datasets],
        *[F.coalesce(F.bool_or(F.when(F.col("dataset") == d, F.col("_is_best"))), F.lit(False)).alias(f"best_{d}")
          for d in datasets])


def top_features(importance: DataFrame, n: int = 15, value_col: str = "importance") -> DataFrame:
    """RPT-6: top-n importances (a top-k report: the limit is the feature)."""
    return importance.orderBy(F.col(value_col).desc()).limit(n)


def forest_table(hr: DataFrame) -> DataFrame:
    """RPT-5: HR with error-bar lengths (clipped at 0), direction, sorted by HR."""
    return hr.select(
        "feature", "hr", "lower_95", "upper_95",
        F.greatest(F.col("hr") - F.col("lower_95"), F.lit(0.0)).alias("err_lo"),
        F.greatest(F.col("upper_95") - F.col("hr"), F.lit(0.0)).alias("err_hi"),
        F.when(F.col("hr") > 1, F.lit("increased risk")).otherwise(F.lit("decreased risk")).alias("direction"),
    ).orderBy("hr")


def patient_curves(model, df: DataFrame, *, id_col: str = "subject_id", step: int = 10,
                   horizon: int = 360) -> DataFrame:
    """RPT-8: per-subject Cox survival on the grid 0..horizon by step."""
    from hazardflow.operators.cox import predict_survival

    return predict_survival(model, df, [float(t) for t in range(0, horizon + 1, step)], id_col=id_col)
