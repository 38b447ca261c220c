"""Closed-form intervals and test statistics as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelflift.functions.columns import ratio

Z_TWO_SIDED_95 = 1.959963984540054      # fixed value: 97.5 % point of the normal distribution
Z_POWER_80 = 0.8416212335729143         # fixed value: 80 % point of the normal distribution


def wilson(successes: Column, n: Column, z: float = Z_TWO_SIDED_95) -> tuple[Column, Column]:
    """Wilson score interval of a proportion."""
    p = ratio(successes, n)
    shrink = 1 + z * z / n
    centre = (p + z * z / (2 * n)) / shrink
    half = z / shrink * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return centre - half, centre + half


def clustered_total_ci(pair_total: Column, z: float) -> Column:
    """Half-width of a range for a sum of independent pair totals (NULL for a single pair)."""
    return z * F.stddev_samp(pair_total) * F.sqrt(F.count(F.lit(1)))


def welch(mean1: Column, var1: Column, n1: Column, mean2: Column, var2: Column, n2: Column) -> tuple[Column, Column]:
    """t statistic and degrees of freedom for two means with unequal variances."""
    a, b = ratio(var1, n1), ratio(var2, n2)
    t = F.try_divide(mean1 - mean2, F.sqrt(a + b))
    df = F.try_divide((a + b) * (a + b), F.try_divide(a * a, n1 - 1) + F.try_divide(b * b, n2 - 1))
    return t, df
