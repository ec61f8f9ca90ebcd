"""Distribution tails (chi-square, F, normal) as small numeric helpers and Arrow UDFs."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normal_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


def gamma_q(a: float, x: float) -> float:
    """Upper regularised incomplete gamma: power series for small x, continued fraction else."""
    if not (x > 0.0):
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1.0
            term *= x / k
            total += term
        return max(0.0, 1.0 - total * front)
    # modified Lentz evaluation
    b, tiny = x + 1.0 - a, 1e-300
    c, d = 1.0 / tiny, 1.0 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2.0
        d = 1.0 / (an * d + b or tiny)
        c = b + an / c or tiny
        step = d * c
        h *= step
        if abs(step - 1.0) < 1e-15:
            break
    return front * h


def beta_i(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta by its continued fraction."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_i(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    ) / a
    tiny = 1e-300
    c, d = 1.0, 1.0 / (1.0 - (a + b) * x / (a + 1.0) or tiny)
    h = d
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0))
        last = 1.0
        for coef in (even, odd):
            d = 1.0 / (1.0 + coef * d or tiny)
            c = 1.0 + coef / c or tiny
            last = d * c
            h *= last
        if abs(last - 1.0) < 1e-15:
            break
    return front * h


def chi2_sf(x: float, k: float) -> float:
    return gamma_q(k / 2.0, x / 2.0)


def f_sf(x: float, d1: float, d2: float) -> float:
    return beta_i(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * x)) if x > 0 else 1.0


@F.pandas_udf(T.DoubleType())
def chi2_tail(x: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(v) else chi2_sf(float(v), float(d)) for v, d in zip(x, k)], dtype="float64")


def chi2_tail_even(x: Column, degrees: int) -> Column:
    """Chi-square tail for an even number of degrees: a finite sum, by Horner's rule."""
    half, total = x / 2.0, F.lit(1.0)
    for i in range(degrees // 2 - 1, 0, -1):
        total = 1.0 + half / float(i) * total
    return F.exp(-half) * total


# Response-surface coefficients of the unit-root test with a constant
# (published tables), lowest order first, and the range they hold in.
UNIT_ROOT_SMALL = (2.1659, 1.4412, 0.038269)
UNIT_ROOT_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
UNIT_ROOT_MIN, UNIT_ROOT_STAR, UNIT_ROOT_MAX = -18.83, -1.61, 2.74
# Critical values of the level-stationarity test (10 %, 5 %, 2.5 %, 1 %).
LEVEL_CRITICAL = (0.347, 0.463, 0.574, 0.739)
LEVEL_P = (0.10, 0.05, 0.025, 0.01)


def unit_root_pvalue(stat: float) -> float:
    if stat > UNIT_ROOT_MAX:
        return 1.0
    if stat < UNIT_ROOT_MIN:
        return 0.0
    coef = UNIT_ROOT_SMALL if stat <= UNIT_ROOT_STAR else UNIT_ROOT_LARGE
    return normal_cdf(sum(c * stat**i for i, c in enumerate(coef)))


def level_pvalue(stat: float) -> float:
    """Interpolated between the critical values, clipped to [0.01, 0.10]."""
    return float(np.interp(stat, LEVEL_CRITICAL, LEVEL_P))
