"""Column functions used by feature preparation (all JVM-side expressions)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket edges and labels of the engineered clinical features.
AGE_BINS = [0, 45, 60, 75, 200]
AGE_LABELS = ["<45", "45-60", "60-75", "75+"]
CCI_BINS = [-1, 1, 3, 6, 100]
CCI_LABELS = ["low", "moderate", "high", "very_high"]
LOS_BINS = [0, 2, 5, 10, 100]
LOS_LABELS = ["short", "medium", "long", "prolonged"]
GRADE_CODES = {"I": 1, "II": 2, "III": 3}


def cut(col: Column, bins: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bucketing ``(b_i, b_{i+1}] -> labels[i]``; outside or NULL -> NULL.

    (``Bucketizer`` is left-closed, the wrong side for these edges.)
    """
    if len(labels) != len(bins) - 1:
        raise ValueError("need one label per interval")
    expr = None
    for lo, hi, lab in zip(bins[:-1], bins[1:], labels):
        cond = (col > F.lit(lo)) & (col <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def ecog_group(col: Column) -> Column:
    """ECOG <= 1 good, <= 2 moderate, otherwise poor; NULL stays NULL."""
    return (F.when(col.isNull(), F.lit(None).cast("string"))
            .when(col <= 1, F.lit("good")).when(col <= 2, F.lit("moderate"))
            .otherwise(F.lit("poor")))


def comorbidity_index(age: Column, diabetes: Column, heart_failure: Column, ckd: Column,
                      copd: Column) -> Column:
    """SRC-4: one point per age >= 50, >= 60, >= 70, diabetes, heart failure, COPD; CKD two."""
    pts = ((age >= 50).cast("int") + (age >= 60).cast("int") + (age >= 70).cast("int")
           + diabetes.cast("int") + heart_failure.cast("int") + 2 * ckd.cast("int")
           + copd.cast("int"))
    return pts.cast("int")


def status_event(status: Column, dead_code: int = 2) -> Column:
    """SRC-1: event = status == dead code."""
    return (status == F.lit(dead_code)).cast("int")


def grade_code(col: Column, default: int = 2) -> Column:
    """SRC-2: I/II/III -> 1/2/3, anything else -> default."""
    expr = None
    for k, v in GRADE_CODES.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(default))


def uniform_hash(key: Column, seed: int) -> Column:
    """Deterministic uniform [0, 1) per key and seed (xxhash64, no state, no shuffle)."""
    h = F.xxhash64(key, F.lit(int(seed)))
    return (F.pmod(h, F.lit(1 << 53)).cast("double")) / F.lit(float(1 << 53))


def repeatable_hash(key: Column, label: str) -> Column:
    """48 bits of an MD5 over ``label:key``, exact in a double; any SQL engine can repeat it."""
    text = F.concat(F.lit(f"{label}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double")
