"""Tails of distributions as vectorised functions (Spark has no erf, gamma or beta integrals)."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_erfc = np.vectorize(math.erfc, otypes=[float])


def _upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma, by series below a + 1 and by continued fraction above."""
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        k = a
        while abs(term) > abs(total) * 1e-15:
            k += 1
            term *= x / k
            total += term
        return 1 - total * front
    b, c = x + 1 - a, 1e300
    d = h = 1 / b
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or 1e-300)
        c = b + an / c or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def _beta_part(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta by Lentz's continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_part(b, a, 1 - x)
    front = math.exp(a * math.log(x) + b * math.log1p(-x) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)) / a
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or 1e-300)
    h = d
    for m in range(1, 1000):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + num * d or 1e-300)
            c = 1 + num / c or 1e-300
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


@F.pandas_udf(DoubleType())
def normal_two_sided(z: pd.Series) -> pd.Series:
    return pd.Series(_erfc(z.abs().astype(float) / math.sqrt(2)))


@F.pandas_udf(DoubleType())
def chi2_upper(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([math.nan if math.isnan(v) or not k else _upper_gamma(k / 2, v / 2) for v, k in zip(x.astype(float), df.astype(float), strict=True)])


def _t_tails(v: np.ndarray, k: np.ndarray) -> np.ndarray:
    """_beta_part(k / 2, 0.5, k / (k + v^2)) of whole arrays; each value takes the steps it would take alone."""
    out = np.full(len(v), np.nan)
    ok = ~np.isnan(v) & ~np.isnan(k) & (k > 0)
    with np.errstate(all="ignore"):
        x = k / (k + v * v)
        out[ok & (x <= 0)], out[ok & (x >= 1)] = 0.0, 1.0
        at = np.flatnonzero(ok & (x > 0) & (x < 1))
        x, a = x[at], k[at] / 2
        b = np.full(len(at), 0.5)
        flip = x > (a + 1) / (a + b + 2)
        x, a, b = np.where(flip, 1 - x, x), np.where(flip, b, a), np.where(flip, a, b)
        gammas = {u: math.lgamma(u + 0.5) - math.lgamma(u) - math.lgamma(0.5) for u in np.unique(k[at] / 2).tolist()} if len(at) else {}
        front = np.exp(a * np.log(x) + b * np.log1p(-x) + np.array([gammas[u] for u in (k[at] / 2).tolist()])) / a
        c, d = np.ones(len(at)), 1 - (a + b) * x / (a + 1)
        h = d = 1 / np.where(d == 0, 1e-300, d)
        done, left = np.full(len(at), np.nan), np.arange(len(at))
        for m in range(1, 1000):
            for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d, c = 1 + num * d, 1 + num / c
                d, c = 1 / np.where(d == 0, 1e-300, d), np.where(c == 0, 1e-300, c)
                h = h * (d * c)
            more = ~(np.abs(d * c - 1) < 1e-15)
            done[left[~more]] = h[~more]
            a, b, x, c, d, h, left = (z[more] for z in (a, b, x, c, d, h, left))
            if not len(left):
                break
        done[left] = h
        out[at] = np.where(flip, 1 - front * done, front * done)
    return out


@F.pandas_udf(DoubleType())
def t_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(_t_tails(t.to_numpy(float), df.to_numpy(float)))


@lru_cache(64)
def _rank_sums(n1: int, n2: int) -> list[int]:
    """In how many of all draws of n1 out of n1 + n2 ranks U is 0, 1, 2, ... n1 * n2: the coefficients of the Gaussian binomial."""
    out = [1] + [0] * (n1 * n2)
    for i in range(1, n1 + 1):
        for u in range(n1 * n2, n2 + i - 1, -1):  # times 1 - q^(n2 + i)
            out[u] -= out[u - n2 - i]
        for u in range(i, n1 * n2 + 1):  # over 1 - q^i
            out[u] += out[u - i]
    return out


@F.pandas_udf(DoubleType())
def rank_sum_exact(n1: pd.Series, n2: pd.Series, u: pd.Series) -> pd.Series:
    """Two-sided p-value of U without ties: twice the chance of one as far from the middle, 1 at most; null where a number is null."""
    def one(a, b, x):
        if pd.isna(a) or pd.isna(b) or pd.isna(x):
            return math.nan
        a, b = sorted((int(a), int(b)))
        ways = _rank_sums(a, b)
        return min(1.0, 2 * sum(ways[math.ceil(max(x, a * b - x)) :]) / math.comb(a + b, a))

    return pd.Series([one(*v) for v in zip(n1, n2, u, strict=True)], dtype=float)
