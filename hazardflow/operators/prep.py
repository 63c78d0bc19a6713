"""Feature preparation: engineering, numeric selection, imputation, scaling, split, validation.

Fitted preprocessing is a small parameter table ``(feature, median, mean, std)`` – one row per
feature – that is inspectable, writable as parquet and applied as literal expressions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from hazardflow.functions import columns as C
from hazardflow.operators.quantiles import exact_percentiles
from hazardflow.operators.scan import null_safe_join, prefix_scan

OUTCOME_AND_LABELS = {"duration", "event", "cause", "subject_id", "age_group", "cci_level",
                      "los_category", "bmi_category", "split"}


def engineer_features(df: DataFrame, dataset: str = "icu") -> DataFrame:
    """PREP-1/2/3: age/cci/los buckets when present; ECOG group (lung); hormone x menopause (gbsg2)."""
    cols = set(df.columns)
    if "age" in cols:
        df = df.withColumn("age_group", C.cut(F.col("age"), C.AGE_BINS, C.AGE_LABELS))
    if "cci" in cols:
        df = df.withColumn("cci_level", C.cut(F.col("cci"), C.CCI_BINS, C.CCI_LABELS))
    if "los" in cols:
        df = df.withColumn("los_category", C.cut(F.col("los"), C.LOS_BINS, C.LOS_LABELS))
    if dataset in ("whas500", "lung") and "ph_ecog" in cols:
        df = df.withColumn("ecog_group", C.ecog_group(F.col("ph_ecog")))
    if dataset == "gbsg2" and {"horTh", "menostat"} <= cols:
        df = df.withColumn("hormone_meno_interaction",
                           (F.col("horTh") * F.col("menostat")).cast("double"))
    return df


def numeric_features(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """PREP-6: numeric columns that are not outcome, id or label columns."""
    skip = OUTCOME_AND_LABELS | set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in skip]


@dataclass
class Scaler:
    """Fitted median / mean / population-std per feature (PREP-4/5)."""

    features: list[str]
    median: dict[str, float]
    mean: dict[str, float]
    std: dict[str, float]

    def table(self, spark) -> DataFrame:
        rows = [(f, self.median[f], self.mean[f], self.std[f]) for f in self.features]
        return spark.createDataFrame(rows, "feature string, median double, mean double, std double")

    def impute(self, df: DataFrame) -> DataFrame:
        fill = {f: self.median[f] for f in self.features if self.median[f] is not None}
        cols = [F.coalesce(F.col(c).cast("double"), F.lit(fill[c])).alias(c) if c in fill else F.col(c)
                for c in df.columns]
        return df.select(*cols)

    def scaled(self, f: str, col: Column | None = None) -> Column:
        col = F.col(f) if col is None else col
        sd = self.std[f] if self.std[f] not in (None, 0.0) else 1.0
        return (col.cast("double") - F.lit(self.mean[f] or 0.0)) / F.lit(sd)

    def transform(self, df: DataFrame) -> DataFrame:
        """Impute with the *fitted* medians, then standardise (same parameters for every split)."""
        df = self.impute(df)
        feats = set(self.features)
        return df.select(*[self.scaled(c).alias(c) if c in feats else F.col(c) for c in df.columns])


def _long(df: DataFrame, features: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                      for c in features])
    return df.select(F.inline(pairs))


def fit_scaler(df: DataFrame, features: Sequence[str]) -> Scaler:
    """Exact interpolated medians, then mean and population std of the imputed columns.

    Two distributed passes; only 3 x p numbers reach the driver.
    """
    features = list(features)
    if not features:
        return Scaler([], {}, {}, {})
    med = exact_percentiles(_long(df, features), "value", [0.5], ["feature"], small_groups=True)
    median = {r["feature"]: r["value"] for r in med.collect()}
    for f in features:
        median.setdefault(f, None)
    filled = [F.coalesce(F.col(f).cast("double"), F.lit(median[f])) for f in features]
    aggs = []
    for f, col in zip(features, filled):
        aggs += [F.avg(col).alias(f"m_{f}"), F.stddev_pop(col).alias(f"s_{f}")]
    row = df.agg(*aggs).collect()[0]
    mean = {f: row[f"m_{f}"] for f in features}
    std = {f: row[f"s_{f}"] for f in features}
    return Scaler(features, median, mean, std)


def preprocess(df: DataFrame, features: Sequence[str] | None = None, scaler: Scaler | None = None,
               fit: bool = True) -> tuple[DataFrame, list[str], Scaler]:
    """PREP-4/5 as the reference's ``preprocess``: fit or reuse; reuse without a scaler is an error."""
    features = list(features) if features is not None else numeric_features(df)
    if fit:
        scaler = fit_scaler(df, features)
    elif scaler is None:
        raise ValueError("scaler must be provided when fit=False")
    return scaler.transform(df), features, scaler


def stratified_split(df: DataFrame, *, strata_col: str = "event", id_col: str = "subject_id",
                     test_size: float = 0.15, val_size: float = 0.15, seed: int = 42,
                     out_col: str = "split") -> DataFrame:
    """PREP-7: exact per-stratum quotas, order by a seeded hash of the id.

    In each stratum of size n: ``n_test = round(n * test)``, ``n_val = round((n - n_test) * val /
    (1 - test))``, the rest train. Ranks come from the bucketed scan (a stratum may be huge).
    """
    if not 0 < test_size < 1 or not 0 <= val_size < 1 - test_size:
        raise ValueError("need 0 < test_size < 1 and 0 <= val_size < 1 - test_size")
    h = C.repeatable_hash(F.col(id_col), f"split:{int(seed)}")
    keyed = df.withColumn("_h", h).withColumn("_one", F.lit(1))
    ranked = prefix_scan(keyed, [strata_col], "_h", {"_rank": "_one"})
    sizes = df.groupBy(strata_col).agg(F.count(F.lit(1)).alias("_n"))
    ranked = null_safe_join(ranked, sizes, [strata_col])
    n = F.col("_n").cast("double")
    n_test = F.round(n * F.lit(test_size))
    n_val = F.round((n - n_test) * F.lit(val_size / (1.0 - test_size)))
    split = (F.when(F.col("_rank") <= n_test, F.lit("test"))
             .when(F.col("_rank") <= n_test + n_val, F.lit("val"))
             .otherwise(F.lit("train")))
    return ranked.select(*df.columns, split.alias(out_col))


@dataclass
class Prepared:
    """What one cohort yields for modelling (PREP-8): splits scaled by the train parameters, features, scaler."""

    train: DataFrame
    val: DataFrame
    test: DataFrame
    features: list[str]
    scaler: Scaler
    raw: DataFrame


def prepare_cohort(df: DataFrame, dataset: str = "icu", *, strata_col: str = "event", id_col: str = "subject_id",
                   seed: int = 42) -> Prepared:
    """PREP-8: engineered features, a 70/15/15 split, and all splits imputed and scaled by train parameters."""
    raw = engineer_features(df, dataset)
    split = stratified_split(raw, strata_col=strata_col, id_col=id_col, seed=seed)
    parts = {name: split.where(F.col("split") == name).drop("split") for name in ("train", "val", "test")}
    features = numeric_features(raw)
    scaler = fit_scaler(parts["train"], features)
    return Prepared(*[scaler.transform(parts[n]) for n in ("train", "val", "test")], features, scaler, raw)


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """PREP-9: drop rows with NULL or NaN in any of ``subset``."""
    cond = F.lit(True)
    types = dict(df.dtypes)
    for c in subset:
        ok = F.col(c).isNotNull()
        if types.get(c) in ("double", "float"):
            ok = ok & ~F.isnan(F.col(c))
        cond = cond & ok
    return df.where(cond)


def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """PREP-10: absent features become 0.0, columns in model order (plus pass-through ``keep``)."""
    have = set(df.columns)
    cols = [F.col(k) for k in keep if k in have]
    cols += [F.col(f).cast("double").alias(f) if f in have else F.lit(0.0).alias(f) for f in features]
    return df.select(*cols)


# Request field bounds (inclusive) and defaults of the scoring schema.
REQUEST_FIELDS: dict[str, tuple[float | None, float | None, float]] = {
    "age": (18.0, 110.0, 65.0),
    "los": (0.0, None, 5.0),
    "sofa_score": (0.0, 24.0, 6.0),
    "creatinine": (0.0, None, 1.0),
    "lactate": (0.0, None, 1.5),
    "map": (0.0, 200.0, 75.0),
    "spo2": (0.0, 100.0, 96.0),
    "diabetes": (0.0, 1.0, 0.0),
    "hypertension": (0.0, 1.0, 0.0),
    "heart_failure": (0.0, 1.0, 0.0),
    "ckd": (0.0, 1.0, 0.0),
    "copd": (0.0, 1.0, 0.0),
    "cci": (0.0, None, 2.0),
}
INTEGER_FIELDS = {"diabetes", "hypertension", "heart_failure", "ckd", "copd"}


def validate_requests(df: DataFrame, fields: Mapping[str, tuple] | None = None) -> DataFrame:
    """PREP-11: fill defaults for absent fields, list out-of-range fields in ``errors``.

    Returns the rows with an ``errors array<string>`` column; empty array = valid.
    """
    fields = fields or REQUEST_FIELDS
    have = set(df.columns)
    vals, checks = [], []
    for name, (lo, hi, default) in fields.items():
        v = F.coalesce(F.col(name).cast("double"), F.lit(default)) if name in have else F.lit(default)
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (v < F.lit(lo))
        if hi is not None:
            bad = bad | (v > F.lit(hi))
        if name in INTEGER_FIELDS:
            bad = bad | (v != F.floor(v))
        bad = bad | F.isnan(v)
        vals.append(v.alias(name))
        checks.append(F.when(bad, F.lit(name)))
    passthrough = [F.col(c) for c in df.columns if c not in fields]
    return df.select(*passthrough, *vals, F.array_compact(F.array(*checks)).alias("errors"))
