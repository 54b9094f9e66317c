"""Tail probabilities for the rank and count tests.

Spark SQL has no erf or incomplete gamma, so these run as Arrow-batched pandas UDFs over
one-row (or few-row) aggregates; the statistics themselves are computed in Spark.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def norm_sf(z: float) -> float:
    """Upper tail of the standard normal."""
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def _gamma_p_series(a: float, x: float) -> float:
    term = 1.0 / a
    total = term
    ap = a
    for _ in range(10_000):
        ap += 1.0
        term *= x / ap
        total += term
        if abs(term) < abs(total) * 1e-16:
            break
    else:
        raise ArithmeticError(f"incomplete gamma series did not converge for a={a}, x={x}")
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _gamma_q_fraction(a: float, x: float) -> float:
    tiny = 1e-300
    b = x + 1.0 - a
    c = 1.0 / tiny
    d = 1.0 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    else:
        raise ArithmeticError(f"incomplete gamma fraction did not converge for a={a}, x={x}")
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def gamma_q(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    if x < a + 1.0:
        return max(0.0, 1.0 - _gamma_p_series(a, x))
    return _gamma_q_fraction(a, x)


def chi2_sf(x: float, dof: float) -> float:
    """Upper tail of the chi-square distribution."""
    if dof is None or dof <= 0 or x is None or math.isnan(x):
        return 1.0
    return gamma_q(dof / 2.0, x / 2.0)


def kolmogorov_sf(lam: float) -> float:
    """Upper tail of the Kolmogorov distribution, P(K > lam)."""
    if lam <= 0:
        return 1.0
    if lam < 1.18:
        # small lam: the theta-function form converges fast
        y = math.exp(-(math.pi ** 2) / (8.0 * lam * lam))
        s = 0.0
        for k in range(1, 200, 2):
            s += y ** (k * k)
        cdf = math.sqrt(2.0 * math.pi) / lam * s
        return min(1.0, max(0.0, 1.0 - cdf))
    s = 0.0
    for k in range(1, 101):
        s += (-1) ** (k - 1) * math.exp(-2.0 * k * k * lam * lam)
    return min(1.0, max(0.0, 2.0 * s))


def mann_whitney_counts(n1: int, n2: int) -> list[int]:
    """Numbers of the orders of n1 and n2 distinct values with U = 0, 1, ..., n1 * n2: the
    coefficients of the product over i of (1 - q^(n2 + i)) / (1 - q^i), in whole numbers."""
    few, many = sorted((n1, n2))
    ways = [1] + [0] * (few * many)
    for i in range(1, few + 1):
        for u in range(len(ways) - 1, many + i - 1, -1):
            ways[u] -= ways[u - many - i]
        for u in range(i, len(ways)):
            ways[u] += ways[u - i]
    return ways


def mann_whitney_exact(u: float, n1: int, n2: int) -> float:
    """Two-sided p-value of U without ties: twice the exact upper tail, at most 1."""
    n1, n2 = int(n1), int(n2)
    ways = mann_whitney_counts(n1, n2)
    upper = math.ceil(max(u, n1 * n2 - u))
    return min(1.0, 2 * sum(ways[upper:]) / sum(ways))


def kolmogorov_exact(d: float, n: int, m: int) -> float:
    """P(D >= d) of the two-sample statistic without ties, by lattice paths: the share of the
    paths from (0, 0) to (n, m) that touch |i/n - j/m| >= d. Of all paths to (i, j) the share
    i / (i + j) comes from (i - 1, j), so shares mix along anti-diagonals and never
    overflow. ``n + m`` steps over at most ``min(n, m) + 1`` places."""
    n, m = sorted((int(n), int(m)))
    if d <= 0:
        return 1.0
    # gaps are whole multiples of 1 / (n m): half of one forgives the rounding of d
    limit = d * n * m - 0.5
    touched = np.zeros(n + 1)
    for s in range(1, n + m + 1):
        low, high = max(0, s - m), min(n, s)
        i = np.arange(low, high + 1)
        stay = touched[low:high + 1] * (s - i)
        if low:
            touched[low:high + 1] = (stay + touched[low - 1:high] * i) / s
        else:
            stay[1:] += touched[:high] * i[1:]
            touched[:high + 1] = stay / s
        gap = np.abs(i * m - (s - i) * n)
        touched[low:high + 1][gap >= limit] = 1.0
    return float(min(1.0, touched[n]))


def _vec(fn, *series):
    return pd.Series([None if any(v is None or (isinstance(v, float) and math.isnan(v)) for v in vals)
                      else fn(*vals) for vals in zip(*series)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def norm_sf_udf(z: pd.Series) -> pd.Series:
    return _vec(norm_sf, z)


@F.pandas_udf(T.DoubleType())
def chi2_sf_udf(x: pd.Series, dof: pd.Series) -> pd.Series:
    return _vec(chi2_sf, x, dof)


@F.pandas_udf(T.DoubleType())
def kolmogorov_sf_udf(lam: pd.Series) -> pd.Series:
    return _vec(kolmogorov_sf, lam)


@F.pandas_udf(T.DoubleType())
def mann_whitney_exact_udf(u: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    return _vec(mann_whitney_exact, u, n1, n2)


@F.pandas_udf(T.DoubleType())
def kolmogorov_exact_udf(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return _vec(kolmogorov_exact, d, n, m)
