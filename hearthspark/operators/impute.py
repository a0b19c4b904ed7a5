"""Imputation: fit on one table, apply to any."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthspark.operators.columns import numeric_names
from hearthspark.operators.joins import lookup
from hearthspark.operators.ordering import running_totals
from hearthspark.session import materialize


# Half the width, in ranks, of the interval that a sketch gives for a median.
BRACKET = 1 / 2000


def value_counts(df: DataFrame, names: Sequence[str], kind: str) -> DataFrame:
    """(variable, value, n) without missing cells; hot values combine on the map side."""
    cast = df.select(*[F.col(name).cast(kind).alias(name) for name in names])
    long = cast.unpivot([], list(names), "variable", "value").filter(F.col("value").isNotNull())
    return long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))


def medians(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Exact median per variable as a table.

    A sketch of all columns in one pass brackets each median; a second pass
    counts what lies below the bracket and the few values inside it, and only
    those are ranked. Nothing wide is shuffled or written.
    """
    sketched = [F.col(name).cast("double") for name in names]
    row = df.agg(*[F.count(x).alias(f"n_{i}") for i, x in enumerate(sketched)], *[
        F.percentile_approx(x, [0.5 - BRACKET, 0.5 + BRACKET], F.lit(int(4 / BRACKET))).alias(f"b_{i}")
        for i, x in enumerate(sketched)]).first()
    known = [(name, row[f"n_{i}"], *row[f"b_{i}"]) for i, name in enumerate(names) if row[f"n_{i}"]]
    if not known:
        return df.sparkSession.createDataFrame([], "variable string, median double")
    # Values below the bracket become one missing value, values above it leave.
    entries = [F.when(value <= F.lit(high), F.struct(
        F.lit(name).alias("variable"), F.when(value >= F.lit(low), value).alias("value")))
        for name, _, low, high in known for value in [F.col(name).cast("double")]]
    inside = df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
    counts = materialize(inside.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n")))
    sizes = df.sparkSession.createDataFrame([(name, n) for name, n, *_ in known], "variable string, _all long")
    below = counts.filter("value is null").select("variable", F.col("n").alias("_below"))
    totals = sizes.join(below, "variable", "left").fillna(0, ["_below"])
    valued = counts.filter("value is not null")
    ranked = lookup(running_totals(valued, "value", ["n"], by=["variable"], written=True), totals, ["variable"])

    def at(rank):
        before = F.col("_below") + F.col("n_before")
        return F.max(F.when((before <= rank) & (rank < before + F.col("n")), F.col("value")))

    low, high = F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)
    return ranked.groupBy("variable").agg(((at(low) + at(high)) / 2).alias("median"))


def fit_median(df: DataFrame, names: Sequence[str], exact: bool = True) -> dict[str, float]:
    """Median per column; ``exact=False`` takes one sketch pass instead."""
    if exact:
        return {row["variable"]: row["median"] for row in medians(df, names).collect()}
    row = df.agg(*[F.percentile_approx(F.col(n).cast("double"), 0.5, F.lit(10000)).alias(n) for n in names]).first()
    return {name: row[name] for name in names if row[name] is not None}


def fit_mean(df: DataFrame, names: Sequence[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(F.col(n).cast("double")).alias(n) for n in names]).first()
    return {name: row[name] for name in names if row[name] is not None}


def modes(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Most frequent value per variable as text; the lowest value of its type on ties, missing ignored."""
    numeric = [name for name in names if name in set(numeric_names(df))]
    number = F.when(F.col("variable").isin(*numeric), F.col("value").cast("double"))
    best = F.min_by("value", F.struct(-F.col("n"), number, F.col("value")))
    return value_counts(df, names, "string").groupBy("variable").agg(best.alias("mode"))


def fit_mode(df: DataFrame, names: Sequence[str]) -> dict[str, str]:
    return {row["variable"]: row["mode"] for row in modes(df, names).collect()}


def fit_mean_or_mode(df: DataFrame, names: Sequence[str]) -> dict[str, object]:
    """Mean of the numeric columns, mode of the others."""
    numeric = set(numeric_names(df))
    means = [name for name in names if name in numeric]
    texts = [name for name in names if name not in numeric]
    return {**(fit_mean(df, means) if means else {}), **(fit_mode(df, texts) if texts else {})}


def apply_fill(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Fitted values into missing cells; a numeric column filled so becomes double."""
    filled = {}
    for name, value in values.items():
        if name in df.columns:
            kind = "double" if isinstance(value, float) else df.schema[name].dataType
            filled[name] = F.coalesce(F.col(name).cast(kind), F.lit(value).cast(kind))
    return df.withColumns(filled) if filled else df
