"""Numeric expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct_over(value: Column, base: Column) -> Column:
    """Percent by which ``value`` exceeds ``base``; 0 when the base is 0."""
    return F.when(base == 0, F.lit(0.0)).otherwise(F.try_divide(value - base, base) * 100)


def variation_pct(col: str) -> Column:
    """Coefficient of variation in percent with the zero-mean guard."""
    mean = F.avg(col)
    return F.when(mean == 0, F.lit(0.0)).otherwise(F.try_divide(F.stddev_samp(col), mean) * 100)


def sample_skewness(col: str) -> Column:
    """Bias-corrected skewness (Spark's built-in is the population form)."""
    n = F.count(col).cast("double")
    return F.when(n > 2, F.skewness(col) * F.sqrt(n * (n - 1)) / (n - 2))


def unlog(pred: Column) -> Column:
    """Back from log1p space; a log prediction of 20 or more is passed through."""
    return F.when(pred < 20, F.expm1(pred)).otherwise(pred)


def band(price: Column, share: float = 0.1) -> tuple[Column, Column]:
    """Fixed relative prediction band."""
    return price * (1 - share), price * (1 + share)


def ratio(num: Column, den: Column) -> Column:
    """num / den, null when den is 0."""
    return F.try_divide(num, den)


def levenshtein_ratio(a: Column, b: Column) -> Column:
    """Edit-distance similarity in percent."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(100.0)).otherwise(
        (F.lit(1.0) - F.levenshtein(a, b) / longest) * 100
    )
