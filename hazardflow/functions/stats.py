"""Distribution tails without scipy (driver scalars) and a JVM-side erfc column."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: two-sided 95 % standard normal quantile.
Z95 = 1.959963984540054


def norm_sf2(z: float) -> float:
    """Two-sided normal tail P(|Z| > |z|)."""
    return math.erfc(abs(z) / math.sqrt(2.0))


def chi2_sf(x: float, df: int) -> float:
    """Upper tail of chi-square with integer df: Q(df/2, x/2) by the half-integer recurrence."""
    if df <= 0:
        return 1.0
    if x <= 0:
        return 1.0
    y = x / 2.0
    if df % 2 == 0:
        s, q, term = 1.0, 0.0, 1.0
        q = term
        for i in range(1, df // 2):
            term *= y / i
            q += term
        return min(1.0, math.exp(-y) * q)
    q = math.erfc(math.sqrt(y))
    s = 0.5
    while s + 1.0 <= df / 2.0 + 1e-9:
        q += math.exp(s * math.log(y) - y - math.lgamma(s + 1.0))
        s += 1.0
    return min(1.0, max(0.0, q))


def erfc_col(x: Column) -> Column:
    """Complementary error function as a column, to about 1e-12 relative.

    Below 2 the positive series of erf; from 2 on the continued fraction, evaluated from its 100th term.
    """
    z = F.abs(x)
    zz = z * z
    start = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))

    def term(acc: Column, n: Column) -> Column:
        t = acc["t"] * 2 * zz / (2 * n + 1)
        return F.struct(t.alias("t"), (acc["s"] + t).alias("s"))

    series = F.aggregate(F.sequence(F.lit(1), F.lit(60)), start, term, lambda acc: acc["s"])
    small = F.lit(1.0) - F.lit(2.0 / math.sqrt(math.pi)) * z * F.exp(-zz) * series
    fraction = F.aggregate(F.sequence(F.lit(100), F.lit(1), F.lit(-1)), F.lit(1.0), lambda acc, n: F.lit(1.0) + n / (2 * zz * acc))
    large = F.exp(-zz) / (z * F.lit(math.sqrt(math.pi)) * fraction)
    ans = F.when(z < 2, small).otherwise(large)
    return F.when(x >= 0, ans).otherwise(F.lit(2.0) - ans)


def chi2_sf_col1(x: Column) -> Column:
    """Chi-square(1) tail as a column: erfc(sqrt(x/2))."""
    return erfc_col(F.sqrt(F.greatest(x, F.lit(0.0)) / 2))


def norm_sf2_col(z: Column) -> Column:
    return erfc_col(F.abs(z) / F.lit(math.sqrt(2.0)))
