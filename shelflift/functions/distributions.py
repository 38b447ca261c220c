"""Tail probabilities as pandas UDFs that go value by value: for result tables of a few rows only."""

from __future__ import annotations

import math
import sys
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

# Send these small functions to the executors by value, so that nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, evaluated with Lentz's method."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 500):
        for term in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            out *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return out


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0.0 or x >= 1.0:
        return min(max(x, 0.0), 1.0)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function Q(a, x)."""
    if x <= 0.0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        k = a
        while abs(term) > 1e-16 * abs(total):
            k += 1.0
            term *= x / k
            total += term
        return 1.0 - front * total
    tiny = 1e-300
    b = x + 1.0 - a
    c, d = 1.0 / tiny, 1.0 / b
    out = d
    for i in range(1, 500):
        b += 2.0
        step = -i * (i - a)
        d = 1.0 / (step * d + b or tiny)
        c = b + step / c or tiny
        out *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front * out


def t_critical(tail: float, nu: float) -> float:
    """The value that Student's t exceeds with probability ``tail`` (below a half): by bisection, with many degrees from the normal value.

    With many degrees the beta function loses digits, while the terms left out of the expansion are below 1e-11.
    """
    if nu > 1000.0:
        z = NormalDist().inv_cdf(1.0 - tail)
        return z + (z ** 3 + z) / (4 * nu) + (5 * z ** 5 + 16 * z ** 3 + 3 * z) / (96 * nu ** 2) + (3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z) / (384 * nu ** 3)
    low, high = 0.0, 1.0
    over = lambda t: incomplete_beta(nu / 2.0, 0.5, nu / (nu + t * t)) / 2.0
    while over(high) > tail:
        low, high = high, high * 2.0
    for _ in range(60):
        middle = (low + high) / 2.0
        low, high = (middle, high) if over(middle) > tail else (low, middle)
    return (low + high) / 2.0


_GRID = np.linspace(-9.0, 9.0, 801)
_NORMAL_OVER = np.vectorize(lambda x: 0.5 * math.erfc(x / math.sqrt(2.0)))


def t_test_power(effect: float, per_group: float, alpha: float) -> float:
    """Power of the two-sided t test of two groups of this size whose means lie ``effect`` standard deviations apart.

    The statistic is (Z + delta) / s, noncentral t; with s given it is normal, and s, the estimated over the true deviation, is integrated out.
    """
    nu = 2.0 * per_group - 2.0
    off = _GRID / math.sqrt(2.0 * nu)  # s - 1
    off = off[off > -1.0]
    density = (nu - 1.0) * np.log1p(off) - nu * off * (2.0 + off) / 2.0
    weight = np.exp(density - density.max())
    delta, bound = abs(effect) * math.sqrt(per_group / 2.0), t_critical(alpha / 2.0, nu) * (1.0 + off)
    return float(weight @ (_NORMAL_OVER(bound - delta) + _NORMAL_OVER(bound + delta)) / weight.sum())


def t_test_group_size(effect: float, alpha: float, power: float) -> float:
    """The smallest group, of two rows at least, with which the t test reaches ``power``; NaN without an effect. Doubling brackets it, halving finds it."""
    if effect == 0.0 or not math.isfinite(effect):
        return math.nan
    low, high = 1, 2
    while t_test_power(effect, high, alpha) < power:
        low, high = high, high * 2
        if high > 1 << 50:
            return math.nan
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if t_test_power(effect, middle, alpha) < power else (low, middle)
    return float(high)


def _each(fn, *series: pd.Series) -> pd.Series:
    values = [fn(*row) if not any(pd.isna(v) for v in row) else np.nan for row in zip(*series)]
    return pd.Series(values, dtype="float64")


@F.pandas_udf(T.DoubleType())
def student_two_sided_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return _each(lambda a, n: incomplete_beta(n / 2.0, 0.5, n / (n + a * a)), t, df)


@F.pandas_udf(T.DoubleType())
def normal_two_sided_p(z: pd.Series) -> pd.Series:
    return _each(lambda a: math.erfc(abs(a) / math.sqrt(2.0)), z)


@F.pandas_udf(T.DoubleType())
def chi_square_p(stat: pd.Series, df: pd.Series) -> pd.Series:
    return _each(lambda x, n: upper_gamma(n / 2.0, x / 2.0) if n > 0 else np.nan, stat, df)


@F.pandas_udf(T.DoubleType())
def group_size_for_power(effect: pd.Series, alpha: pd.Series, power: pd.Series) -> pd.Series:
    return _each(t_test_group_size, effect, alpha, power)
