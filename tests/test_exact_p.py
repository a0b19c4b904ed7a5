"""The exact p of the two-sample distance against all ways to deal the values."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest

from hearthspark.functions.pvalues import smirnov_tail
from hearthspark.operators import drift


def distance(a, b):
    return max(abs(np.mean(np.array(a) <= x) - np.mean(np.array(b) <= x)) for x in [*a, *b])


def enumerated(a, b):
    pooled = [*a, *b]
    found = distance(a, b)
    ways = [distance([pooled[i] for i in chosen], [pooled[i] for i in range(len(pooled)) if i not in chosen])
            for chosen in combinations(range(len(pooled)), len(a))]
    return np.mean([d >= found - 1e-12 for d in ways])


def counts(a, b):
    values = sorted({*a, *b})
    return np.array([a.count(v) for v in values]), np.array([b.count(v) for v in values])


@pytest.mark.parametrize("levels", [2, 4, 1000])
def test_equal_to_enumeration(levels):
    source = np.random.default_rng(levels)
    for _ in range(12):
        a, b = (source.integers(0, levels, source.integers(1, 7)).tolist() for _ in range(2))
        assert smirnov_tail(*counts(a, b)) == pytest.approx(enumerated(a, b), abs=1e-12)


def test_eight_and_eight():
    a, b = [1, 2, 2, 3, 5, 5, 6, 9], [4, 5, 7, 8, 8, 9, 9, 10]
    assert smirnov_tail(*counts(a, b)) == pytest.approx(enumerated(a, b), abs=1e-12)


def test_extremes():
    assert smirnov_tail(np.array([3, 0]), np.array([0, 3])) == pytest.approx(2 / 20)
    assert smirnov_tail(np.array([2, 2]), np.array([1, 1])) == 1
    assert np.isnan(smirnov_tail(np.array([2]), np.array([0])))


def test_small_variables_get_the_exact_p(spark):
    a, b = [1.0, 2.0, 2.0, 3.0], [2.0, 4.0, 4.0, 5.0, 6.0]
    first = spark.createDataFrame([(x, x) for x in a], "x double, y double")
    second = spark.createDataFrame([(x, None) for x in b], "x double, y double")
    (row,) = drift.kolmogorov_smirnov(first, second, ["x", "y"]).collect()
    assert row["variable"] == "x" and row["p_value"] == pytest.approx(enumerated(a, b))
    (limit,) = drift.kolmogorov_smirnov(first, second, ["x"], exact_below=20).collect()
    assert limit["p_value"] != pytest.approx(row["p_value"], abs=1e-3)
