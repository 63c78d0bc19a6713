"""SCORE-1: batch scoring – validate, align, scale, survival at fixed times, risk.

Model parameters are literals in the plan (a Cox model is p coefficients plus H0 at the few
prediction times), so scoring is a single narrow projection over the input: no join, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardflow.operators import cox as cox_ops
from hazardflow.operators.prep import Scaler, align_features, validate_requests

# Prediction horizons (days) of the scoring response.
PREDICT_TIMES = [30, 90, 180, 365]
MESSAGE = "Survival probability at standard clinical time points."


def score_columns(model: cox_ops.CoxModel, h0: Sequence[float], times: Sequence[float]) -> list:
    eta = model.log_partial_hazard()
    surv = F.create_map(*[x for t, h in zip(times, h0)
                          for x in (F.lit(f"{int(t)}d"),
                                    F.round(F.exp(-F.lit(float(h)) * F.exp(eta)), 4))])
    return [surv.alias("survival_probabilities"), F.round(eta, 4).alias("risk_score")]


def score_batch(requests: DataFrame, model: cox_ops.CoxModel, *, model_name: str,
                scaler: Scaler | None = None, id_col: str = "subject_id",
                times: Sequence[float] = PREDICT_TIMES, validate: bool = True,
                h0: Sequence[float] | None = None) -> tuple[DataFrame, DataFrame]:
    """Returns (scored, rejected). Rejected rows keep their ``errors`` list."""
    checked = validate_requests(requests) if validate else requests.withColumn(
        "errors", F.array().cast("array<string>"))
    good = checked.where(F.size("errors") == 0)
    bad = checked.where(F.size("errors") > 0)
    aligned = align_features(good, model.features, keep=[id_col])
    if scaler is not None:
        aligned = aligned.select(id_col, *[scaler.scaled(f).alias(f) if f in scaler.features else F.col(f)
                                           for f in model.features])
    h0 = list(h0) if h0 is not None else cox_ops.baseline_at(model, times)
    scored = aligned.select(id_col, F.lit(model_name).alias("model"), *score_columns(model, h0, times),
                            F.lit(MESSAGE).alias("message"))
    return scored, bad
