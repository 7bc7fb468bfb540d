"""Tails of distributions: as Catalyst expressions where a closed form allows, else NumPy kernels for Arrow UDFs."""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .ids import col

# Rational approximations of erf and erfc by W. J. Cody (1969).
_A = [3.16112374387056560e00, 1.13864154151050156e02, 3.77485237685302021e02, 3.20937758913846947e03, 1.85777706184603153e-1]
_B = [2.36012909523441209e01, 2.44024637934444173e02, 1.28261652607737228e03, 2.84423683343917062e03]
_C = [5.64188496988670089e-1, 8.88314979438837594e0, 6.61191906371416295e01, 2.98635138197400131e02, 8.81952221241769090e02, 1.71204761263407058e03, 2.05107837782607147e03, 1.23033935479799725e03, 2.15311535474403846e-8]
_D = [1.57449261107098347e01, 1.17693950891312499e02, 5.37181101862009858e02, 1.62138957456669019e03, 3.29079923573345963e03, 4.36261909014324716e03, 3.43936767414372164e03, 1.23033935480374942e03]
_P = [3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1, 1.60837851487422766e-2, 6.58749161529837803e-4, 1.63153871373020978e-2]
_Q = [2.56852019228982242e00, 1.87295284992346725e00, 5.27905102951428412e-1, 6.05183413124413191e-2, 2.33520497626869185e-3]


def _ratio(x: Column, num: list[float], den: list[float], lead: float, last_num: float, last_den: float) -> Column:
    n, d = x * lead, x
    for a, b in zip(num, den):
        n, d = (n + a) * x, (d + b) * x
    return (n + last_num) / (d + last_den)


def erfc(x: Column | str) -> Column:
    """The complementary error function to double precision, inside whole-stage code."""
    x = col(x)
    y = F.abs(x)
    z = x * x
    small = 1 - x * _ratio(z, _A[:3], _B[:3], _A[4], _A[3], _B[3])
    head = F.floor(y * 16).cast("double") / 16
    scale = F.exp(-head * head) * F.exp(-(y - head) * (y + head))
    middle = scale * _ratio(y, _C[:7], _D[:7], _C[8], _C[7], _D[7])
    w = F.try_divide(F.lit(1.0), z)
    large = scale * F.try_divide(F.lit(1 / math.sqrt(math.pi)) - w * _ratio(w, _P[:4], _Q[:4], _P[5], _P[4], _Q[4]), y)
    tail = F.when(y <= 4, middle).otherwise(large)
    return F.when(y <= 0.46875, small).when(x < 0, 2 - tail).otherwise(tail)


def normal_sf(z: Column | str) -> Column:
    """The upper tail of the standard normal distribution."""
    return erfc(col(z) / math.sqrt(2)) / 2


def betainc(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function, by its continued fraction (Lentz)."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1 - betainc(b, a, 1 - x)
    tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + step * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + step / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) * h / a


def student_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|) for Student's t with df degrees of freedom."""
    return betainc(df / 2, 0.5, df / (df + t * t))


@functools.lru_cache(maxsize=512)
def _mwu_counts(n: int, m: int) -> np.ndarray:
    """The number of ways each U statistic arises without ties, as shares of all ways; n <= m."""
    ways = np.zeros(n * m + 1)
    ways[0] = 1.0
    for i in range(1, n + 1):  # the Gaussian binomial: times (1 - q^(m+i)) / (1 - q^i), and the mean step to stay in range
        top = ways.copy()
        if m + i < len(top):
            top[m + i :] -= ways[: len(ways) - m - i]
        for k in range(i, len(top)):
            top[k] += top[k - i]
        ways = top * (i / (m + i))
    return ways


def mwu_exact_two_sided(u: float, n: int, m: int) -> float:
    """The two-sided exact p of the Mann-Whitney U statistic of sizes n and m without ties."""
    high = max(u, n * m - u)
    ways = _mwu_counts(min(n, m), max(n, m))
    return min(1.0, 2 * float(ways[int(round(high)) :].sum()))


def ks_exact_two_sided(d: float, n: int, m: int) -> float:
    """P(D >= d) of the two-sample Kolmogorov-Smirnov statistic: lattice paths that stay within the band."""
    reach = int(round(d * n * m))
    if reach == 0:
        return 1.0
    j = np.arange(m + 1)
    inside = np.where(j * n < reach, 1.0, 0.0)
    paths = np.cumprod(inside)  # row 0: only steps in j
    for i in range(1, n + 1):
        # share of paths to (i, j): from above with weight i/(i+j), from the left with j/(i+j)
        ok = np.abs(i * m - j * n) < reach
        row = np.zeros(m + 1)
        left = 0.0
        lo, hi = max(0, math.floor((i * m - reach) / n)), min(m, math.ceil((i * m + reach) / n))
        for k in range(lo, hi + 1):
            if ok[k]:
                left = (paths[k] * i + left * k) / (i + k)
                row[k] = left
            else:
                left = 0.0
        paths = row
    return float(min(1.0, max(0.0, 1 - paths[m])))


def ks_asymptotic_two_sided(d: float, n: int, m: int) -> float:
    x = d * math.sqrt(n * m / (n + m))
    return 1.0 if x < 0.2 else min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 101))))


@F.pandas_udf(DoubleType())
def student_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(a) or pd.isna(b) else student_two_sided(a, b) for a, b in zip(t, df)], dtype="float64")


@F.pandas_udf(DoubleType())
def mwu_exact_p(u: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(a) else mwu_exact_two_sided(a, int(b), int(c)) for a, b, c in zip(u, n, m)], dtype="float64")


@F.pandas_udf(DoubleType())
def ks_p(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    """Exact up to 10,000 values a side, asymptotic beyond."""
    return pd.Series([None if pd.isna(a) else (ks_exact_two_sided if max(b, c) <= 10_000 else ks_asymptotic_two_sided)(a, int(b), int(c)) for a, b, c in zip(d, n, m)], dtype="float64")
