"""Splits, folds, class balance and stratified samples.

Every choice is a rank of the hashed row key inside its group, so the same
rows come back on any cluster, and the exact sizes hold for any group size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthspark.functions.draws import draw
from hearthspark.operators.joins import lookup
from hearthspark.operators.ordering import segments
from hearthspark.operators.profile import class_distribution, share_within


def _parts(df: DataFrame, name: str, first: str, second: str) -> DataFrame:
    return df.withColumn(name, F.when(F.col(name) == 0, F.lit(first)).otherwise(F.lit(second)))


def split_random(df: DataFrame, key: str, share: float = 0.8, seed: int = 42, name: str = "split") -> DataFrame:
    """``floor(share * n)`` rows marked train, the rest test."""
    cut = segments(df, name, key, lambda n: [F.floor(n * F.lit(share))], seed=seed)
    return _parts(cut, name, "train", "test")


def split_stratified(df: DataFrame, key: str, label: str, share: float = 0.8, seed: int = 42,
                     name: str = "split") -> DataFrame:
    """The same inside each class."""
    cut = segments(df, name, key, lambda n: [F.floor(n * F.lit(share))], by=[label], seed=seed)
    return _parts(cut, name, "train", "test")


def split_by_draw(df: DataFrame, key: str, share: float = 0.8, seed: int = 42, name: str = "split") -> DataFrame:
    """A split of approximate size in a single pass: compares the draw with a fixed digest."""
    bound = f"{min(int(share * 16**8), 16**8 - 1):08x}"
    return df.withColumn(name, F.when(draw(key, seed) < bound, F.lit("train")).otherwise(F.lit("test")))


def complement(df: DataFrame, part: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is not in ``part``."""
    return df.join(part.select(key), key, "left_anti")


def folds(df: DataFrame, key: str, k: int, stratify: str | None = None, seed: int = 42,
          name: str = "fold") -> DataFrame:
    """Fold number 0..k-1, sizes equal to within one row in every class."""
    def cuts(n: Column) -> list[Column]:
        return [F.floor(n * F.lit(j) / F.lit(k)) for j in range(1, k)]

    return segments(df, name, key, cuts, by=[stratify] if stratify else [], seed=seed)


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    """(label, n) of the classes; rows without a label belong to none."""
    return class_distribution(df.filter(F.col(label).isNotNull()), label)


def two_classes(df: DataFrame, label: str) -> dict[object, int]:
    """The sizes of two classes; any other number of them is an error."""
    rows = class_sizes(df, label).limit(3).collect()
    if len(rows) != 2:
        raise ValueError(f"{label} doesn't have two classes")
    return {row[label]: row["n"] for row in rows}


def undersample(df: DataFrame, key: str, label: str, seed: int = 42) -> DataFrame:
    """Every class cut to the size of the smallest; rows without a label leave."""
    smallest = class_sizes(df, label).agg(F.min("n").alias("n")).first()["n"] or 0
    known = df.filter(F.col(label).isNotNull())
    cut = segments(known, "_segment", key, lambda n: [F.lit(smallest)], by=[label], seed=seed)
    return cut.filter("_segment = 0").drop("_segment")


def class_weights(df: DataFrame, label: str, boost: dict[object, float] | None = None) -> DataFrame:
    """Per class: rows, and the balanced weight rows / (classes * rows of the class)."""
    sizes = class_sizes(df, label)
    whole = sizes.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).first()
    weight = F.lit(float(whole["n"] or 0)) / (F.lit(whole["k"]) * F.col("n"))
    for value, factor in (boost or {}).items():
        weight = F.when(F.col(label) == value, weight * factor).otherwise(weight)
    return sizes.withColumn("weight", weight)


def positive_ratio(weights: DataFrame, label: str, positive: object = 1) -> float:
    """Weight of the positive class over the weight of the other."""
    rows = {row[label]: row["weight"] for row in weights.limit(3).collect()}
    if len(rows) != 2 or positive not in rows:
        raise ValueError("the weight ratio needs two classes, one of them the positive one")
    other = next(value for value in rows if value != positive)
    return rows[positive] / rows[other]


def with_weights(df: DataFrame, weights: DataFrame, label: str, name: str = "weight") -> DataFrame:
    return lookup(df, weights.select(label, F.col("weight").alias(name)), [label])


def matched_sample(source: DataFrame, target: DataFrame, key: str, strata: Sequence[str], seed: int = 42) -> DataFrame:
    """From each stratum of ``source`` the share it has among its siblings in ``target``.

    Siblings agree in all strata columns but the last. A stratum that
    ``target`` lacks is kept whole. Missing equals missing.
    """
    wanted = share_within(target, strata, strata[:-1], share="_share").select(*strata, "_share")

    def cuts(n: Column) -> list[Column]:
        share = F.least(F.lit(1.0), F.coalesce(F.col("_share"), F.lit(1.0)))
        return [F.bround(share * n, 0)]

    cut = segments(source, "_segment", key, cuts, by=strata, seed=seed, quotas=wanted)
    return cut.filter("_segment = 0").drop("_segment")
