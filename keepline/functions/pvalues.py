"""Tail probabilities that Spark has no function for, as small Pandas functions.

They run on results with one row per test or per pair of models.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def chi2_tail(x: float, df: int) -> float:
    """P(X > x) for a chi-square with whole degrees of freedom (finite series)."""
    if x <= 0:
        return 1.0
    half = x / 2.0
    if df % 2 == 0:
        term, total = 1.0, 1.0
        for i in range(1, df // 2):
            term *= half / i
            total += term
        return math.exp(-half) * total
    total = math.erfc(math.sqrt(half))
    term = math.exp(-half) * math.sqrt(half) / math.gamma(1.5)
    for i in range((df - 1) // 2):
        total += term
        term *= half / (i + 1.5)
    return total


_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(400)


def _phi(z):
    return 0.5 * np.vectorize(math.erfc)(-z / math.sqrt(2.0))


def studentized_range_tail(q: float, k: int) -> float:
    """P(Q > q) for k means and unlimited degrees of freedom, by quadrature."""
    if q <= 0:
        return 1.0
    lo, hi = -8.0, 8.0 + q
    z = (hi - lo) / 2 * _NODES + (hi + lo) / 2
    density = np.exp(-z * z / 2) / math.sqrt(2 * math.pi)
    inner = k * density * (_phi(z) - _phi(z - q)) ** (k - 1)
    return float(min(1.0, max(0.0, 1.0 - (hi - lo) / 2 * np.sum(_WEIGHTS * inner))))


def signed_rank_tail(ranks, w_min: float, n_zero: int) -> float:
    """Two-sided p of the signed-rank statistic for the given ranks of absolute differences.

    Exact while there are no ties or zeros and at most 50 pairs; with ties or zeros and at
    most 13 pairs all sign patterns are counted; otherwise the normal approximation.
    """
    r = np.asarray(ranks, dtype=float)
    n = len(r)
    if n == 0:
        return 1.0
    tied = len(np.unique(r)) < n
    if (not tied and n_zero == 0 and n <= 50) or n + n_zero <= 13:
        twice = np.rint(2 * r).astype(int)
        ways = np.zeros(twice.sum() + 1)
        ways[0] = 1.0
        for t in twice:
            moved = np.zeros_like(ways)
            moved[t:] = ways[: len(ways) - t]
            ways = ways + moved
        below = ways[: int(round(2 * w_min)) + 1].sum() / ways.sum()
        return float(min(1.0, 2 * below))
    _, sizes = np.unique(r, return_counts=True)
    mean = n * (n + 1) / 4
    spread = n * (n + 1) * (2 * n + 1) - (sizes.astype(float) ** 3 - sizes).sum() / 2
    z = abs(w_min - mean) / math.sqrt(spread / 24)
    return math.erfc(z / math.sqrt(2.0))


@F.pandas_udf(T.DoubleType())
def chi2_p(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([chi2_tail(float(a), int(b)) if pd.notna(a) else None
                      for a, b in zip(x, df)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def range_p(q: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series([studentized_range_tail(float(a), int(b)) if pd.notna(a) else None
                      for a, b in zip(q, k)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def signed_rank_p(ranks: pd.Series, w: pd.Series, n_zero: pd.Series) -> pd.Series:
    return pd.Series([signed_rank_tail(r, float(a), int(z))
                      for r, a, z in zip(ranks, w, n_zero)], dtype="float64")
