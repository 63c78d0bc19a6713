"""One interface for every fitted model (survey 2.11): risk and survival as DataFrames.

Evaluation, importance and scoring take a ``Scorer`` and never ask which model it is. ``id_cols`` are the
columns that name a row; they pass through, so a caller may add keys (a permutation, a request) of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardflow.operators import boosting, cox
from hazardflow.operators.prep import Scaler, align_features, validate_requests
from hazardflow.plans import comparison


class Scorer(Protocol):
    features: list[str]

    def risk(self, df: DataFrame, id_cols: Sequence[str] | None = None) -> DataFrame:
        """(ids, risk): higher is sooner."""

    def survival(self, df: DataFrame, times: Sequence[float], id_cols: Sequence[str] | None = None) -> DataFrame:
        """(ids, time, survival) at a few times."""


def _curve(df: DataFrame, ids: Sequence[str], score: str, times: Sequence[float], hazards: Sequence[float]) -> DataFrame:
    """``exp(-H0(t) exp(score))`` at times whose baseline hazards are known numbers: no join."""
    at = F.array(*[F.struct(F.lit(float(t)).alias("time"), F.exp(-F.lit(float(h)) * F.exp(score)).alias("survival"))
                   for t, h in zip(times, hazards)])
    return df.select(*ids, F.inline(at))


@dataclass
class CoxScorer:
    model: cox.CoxModel
    id_col: str = "subject_id"

    @property
    def features(self) -> list[str]:
        return self.model.features

    def risk(self, df: DataFrame, id_cols: Sequence[str] | None = None) -> DataFrame:
        return df.select(*(id_cols or [self.id_col]), self.model.log_partial_hazard().alias("risk"))

    def survival(self, df: DataFrame, times: Sequence[float], id_cols: Sequence[str] | None = None) -> DataFrame:
        scored = df.withColumn("_score", self.model.log_partial_hazard())
        return _curve(scored, list(id_cols or [self.id_col]), "_score", times, cox.baseline_at(self.model, times))


@dataclass
class BoostedScorer:
    """A boosted model with the Breslow hazard of its training rows."""

    model: boosting.BoostedCox
    train: DataFrame = field(repr=False)
    id_col: str = "subject_id"
    time_col: str = "duration"
    event_col: str = "event"

    @property
    def features(self) -> list[str]:
        return self.model.features

    def risk(self, df: DataFrame, id_cols: Sequence[str] | None = None) -> DataFrame:
        return self.model.score(df, "_score").select(*(id_cols or [self.id_col]), F.col("_score").alias("risk"))

    def survival(self, df: DataFrame, times: Sequence[float], id_cols: Sequence[str] | None = None) -> DataFrame:
        hazards = boosting.hazard_at(self.model, self.train, times, time_col=self.time_col, event_col=self.event_col)
        return _curve(self.model.score(df, "_score"), list(id_cols or [self.id_col]), "_score", times, hazards)


def evaluate(name: str, dataset: str, scorer: Scorer, train: DataFrame, test: DataFrame,
             times: Sequence[float] = comparison.CLINICAL_TIMES) -> DataFrame:
    """EV-7 for any scorer."""
    return comparison.evaluate_model(name, dataset, train, test, scorer.risk(test), scorer.survival(test, times), times)


def patient_curves(scorer: Scorer, df: DataFrame, *, step: int = 10, horizon: int = 360) -> DataFrame:
    """RPT-8 for any scorer: survival of every subject on the grid 0..horizon by step."""
    return scorer.survival(df, [float(t) for t in range(0, horizon + 1, step)])


def score_requests(requests: DataFrame, scorer: Scorer, *, model_name: str, scaler: Scaler | None = None, id_col: str = "subject_id",
                   times: Sequence[float] = (30, 90, 180, 365)) -> tuple[DataFrame, DataFrame]:
    """SCORE-1 for any scorer: (scored, rejected); range checks, defaults, alignment and scaling come first.

    ``scored``: id, model, one ``survival_<t>d`` a time and ``risk_score``, rounded to 4 places.
    """
    checked = validate_requests(requests)
    aligned = align_features(checked.where(F.size("errors") == 0), scorer.features, keep=[id_col])
    if scaler is not None:
        aligned = aligned.select(id_col, *[scaler.scaled(f).alias(f) if f in scaler.features else F.col(f) for f in scorer.features])
    wide = scorer.survival(aligned, list(times), [id_col]).groupBy(id_col).agg(
        *[F.round(F.max(F.when(F.col("time") == float(t), F.col("survival"))), 4).alias(f"survival_{int(t)}d") for t in times])
    risk = scorer.risk(aligned, [id_col]).select(id_col, F.round("risk", 4).alias("risk_score"))
    scored = wide.join(risk, id_col).select(id_col, F.lit(model_name).alias("model"), *[f"survival_{int(t)}d" for t in times], "risk_score")
    return scored, checked.where(F.size("errors") > 0)
