"""p-values of the two test statistics; both work on one row per variable."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SERIES_TERMS = 20
RECURRENCES = 100


def kolmogorov_p(distance: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p of the two-sample statistic.

    Two forms of the same limit law: the alternating series converges fast for
    a large argument, its theta transform for a small one.
    """
    x = F.sqrt(n.cast("double") * m / (n + m)) * distance
    terms = F.sequence(F.lit(1), F.lit(SERIES_TERMS))
    tail = F.aggregate(terms, F.lit(0.0), lambda acc, k: acc + F.when(k % 2 == 1, F.lit(2.0)).otherwise(
        F.lit(-2.0)) * F.exp(F.lit(-2.0) * k * k * x * x))
    odd = F.aggregate(terms, F.lit(0.0), lambda acc, k: acc + F.exp(
        F.lit(-math.pi**2 / 8) * (k * 2 - 1) * (k * 2 - 1) / (x * x)))
    small = F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / x * odd
    return F.when(x < 0.04, F.lit(1.0)).when(x < 1, small).otherwise(F.greatest(F.lit(0.0), tail))


def smirnov_tail(a: np.ndarray, b: np.ndarray) -> float:
    """Exact two-sided p of the two-sample statistic, given how often each distinct value, ascending, is in each sample.

    All ways to deal the pooled values to samples of these sizes are equally
    likely; a way is a path of steps, and the distance counts only where a
    distinct value ends. The mass of paths at each (step, number dealt to the
    first sample) goes on by one step, and is taken out where a value ends and
    the distance is as large as the one found.
    """
    n, m = int(a.sum()), int(b.sum())
    if not n or not m:
        return math.nan
    # Distances times n * m are whole numbers.
    found = int(np.abs(np.cumsum(a) * m - np.cumsum(b) * n).max())
    ends = set(np.cumsum(a + b).tolist())
    i = np.arange(n + 1)
    inside = np.zeros(n + 1)
    inside[0] = 1.0
    outside = 0.0
    for step in range(1, n + m + 1):
        j, left = step - 1 - i, n + m - step + 1
        on = inside * np.clip((n - i) / left, 0, 1)
        stay = inside * np.clip((m - j) / left, 0, 1)
        inside = stay
        inside[1:] += on[:-1]
        if step in ends:
            far = np.abs(i * m - (step - i) * n) >= found
            outside += inside[far].sum()
            inside[far] = 0.0
    return min(1.0, float(outside))


def student_tail(t: float, df: float) -> float:
    """P(|T| > |t|) by integrating the density after t = sqrt(df) tan(angle)."""
    if not (math.isfinite(t) and math.isfinite(df)) or df <= 0:
        return math.nan
    start = math.atan(abs(t) / math.sqrt(df))
    nodes, weights = np.polynomial.legendre.leggauss(64)
    # The density falls off within a few multiples of 1/sqrt(df) of the start.
    edges = np.unique(np.clip(start + np.array([0, 1, 2, 4, 8, 16, 1e9]) / math.sqrt(df), start, math.pi / 2))
    total = 0.0
    for low, high in zip(edges[:-1], edges[1:]):
        angle = (high - low) / 2 * nodes + (high + low) / 2
        # cos(angle) ** (df - 1), exact for angles near zero and any df
        density = np.exp((df - 1) / 2 * np.log1p(-np.sin(angle) ** 2))
        total += (high - low) / 2 * float(np.dot(weights, density))
    return min(1.0, 2 * gamma_ratio(df) / math.sqrt(math.pi) * total)


def gamma_ratio(df: float) -> float:
    """gamma((df + 1) / 2) / gamma(df / 2), by its recurrence and the series for large arguments."""
    product = 1.0
    for step in range(RECURRENCES):
        product *= (df + 2 * step) / (df + 2 * step + 1)
    top = df + 2 * RECURRENCES
    series = 1 - 1 / (4 * top) + 1 / (32 * top**2) + 5 / (128 * top**3) - 21 / (2048 * top**4)
    return product * math.sqrt(top / 2) * series


def student_p(t: Column, df: Column) -> Column:
    @F.pandas_udf("double")
    def two_sided(ts: pd.Series, dfs: pd.Series) -> pd.Series:
        return pd.Series([student_tail(a, b) for a, b in zip(ts, dfs)])

    return F.when(t.isNotNull() & df.isNotNull(), two_sided(F.coalesce(t, F.lit(0.0)), F.coalesce(df, F.lit(1.0))))
