"""Two-sided p-values, applied to one row per predictor."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def student_t_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|) for ``df`` degrees of freedom, by the regularised incomplete beta."""
    if math.isnan(t) or math.isnan(df) or df <= 0:
        return math.nan
    if t == 0.0:
        return 1.0
    ratio = t * t / df
    if math.isinf(ratio):
        return 0.0
    if df > 1e6:
        # Normal deviate equivalent to t; its relative error is of order 1 / df^2.
        z = (8 * df + 1) / (8 * df + 3) * math.sqrt(df * math.log1p(ratio))
        return normal_two_sided(z)
    a, b = df / 2.0, 0.5
    x, y = 1.0 / (1.0 + ratio), ratio / (1.0 + ratio)
    front = math.exp(_log_inverse_beta_half(a) - a * math.log1p(ratio) + b * math.log(y))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, y) / b


def _log_inverse_beta_half(a: float) -> float:
    """log(Gamma(a + 1/2) / (Gamma(a) Gamma(1/2)))."""
    if a < 100:
        gap = math.lgamma(a + 0.5) - math.lgamma(a)
    else:
        gap = 0.5 * math.log(a) - 1 / (8 * a) + 1 / (192 * a**3) - 1 / (640 * a**5)
    return gap - 0.5 * math.log(math.pi)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c = 1.0
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 100_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            value *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return value


@F.pandas_udf(DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    values = [student_t_two_sided(a, b) for a, b in zip(t.astype(float), df.astype(float))]
    return pd.Series(values, dtype="float64").where(lambda p: p.notna(), None)


@F.pandas_udf(StringType())
def scientific_text(x: pd.Series) -> pd.Series:
    """``%.6e`` text of the exact binary value, which may round ties unlike the JVM's formatter."""
    return x.map(lambda v: None if pd.isna(v) else f"{v:.6e}").astype(object)


def scientific_column(name: str) -> Column:
    """``%.6e`` text of the exact binary value of a column, ties to even, without Python.

    The JVM rounds the shortest decimal that stands for a value, halves up. That differs only if
    this decimal has eight digits and ends in 5; then the sign of the exact value less it decides.
    Between 1e-14 and 1e29 the sign is exact; beyond, halves go up. Subnormal numbers with fewer than
    seven digits give the digits of their shortest decimal.
    """
    x = F.col(name).cast("double")
    text = F.format_string("%.7e", x)
    mantissa, power = F.substring_index(text, "e", 1), F.substring_index(text, "e", -1)
    digits = F.regexp_replace(mantissa, "[^0-9]", "").cast("double")
    scale = F.lit(7) - power.cast("int")

    def fma(a: Column, b: Column, c: Column) -> Column:
        return F.reflect(F.lit("java.lang.Math"), F.lit("fma"), a, b, c).cast("double")

    ten = F.pow(F.lit(10.0), F.abs(scale).cast("double"))
    over = F.when(scale >= 0, fma(F.abs(x), ten, -digits)).otherwise(-fma(digits, ten, -F.abs(x)))
    down = (over < 0) | (over == 0) & (F.floor(digits / 10) % 2 == 0)
    halfway = mantissa.endswith("5") & (text.cast("double") == x) & (F.abs(scale) <= 22)
    cut = F.concat(F.substring_index(mantissa, ".", 1), F.lit("."),
                   F.substring(F.substring_index(mantissa, ".", -1), 1, 6), F.lit("e"), power)
    return F.when(halfway, F.when(down, cut).otherwise(F.format_string("%.6e", x))).when(
        x.isNotNull(), F.format_string("%.6e", x)
    )
