"""Profiles: missing shares, moments, class tables, shares inside groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthspark.functions.nulls import members, or_zero
from hearthspark.operators.columns import is_infinite
from hearthspark.operators.joins import null_safe


def long_form(row: DataFrame, fields: dict[str, dict[str, Column]]) -> DataFrame:
    """A one-row summary as one row per variable: explode an array of structs."""
    entries = [
        F.struct(F.lit(variable).alias("variable"), *[value.alias(name) for name, value in stats.items()])
        for variable, stats in fields.items()
    ]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(members().alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def missing_percentage(df: DataFrame) -> DataFrame:
    """Percentage of missing cells for every column, from one pass."""
    row = df.agg(members().alias("_rows"), *[F.count(name).alias(name) for name in df.columns])
    missing = {
        name: {"pct_missing": F.try_divide((F.col("_rows") - F.col(name)) * F.lit(100.0), F.col("_rows"))}
        for name in df.columns
    }
    return long_form(row, missing)


def columns_with_missing(df: DataFrame) -> DataFrame:
    return missing_percentage(df).filter("pct_missing > 0")


def missing_total(df: DataFrame) -> DataFrame:
    cells = sum((F.count_if(F.col(name).isNull()) for name in df.columns), F.lit(0))
    return df.agg(cells.cast("long").alias("missing_cells"))


def infinite_total(df: DataFrame, names: Sequence[str]) -> DataFrame:
    cells = sum((F.count_if(is_infinite(name)) for name in names), F.lit(0))
    return df.agg(cells.cast("long").alias("infinite_cells"))


def describe(df: DataFrame, names: Sequence[str], digits: int | None = 2, suffix: str = "") -> DataFrame:
    """Non-missing %, mean and sample sd per variable; halves round to even."""
    parts: list[Column] = [members().alias("_rows")]
    for name in names:
        value = F.col(name).cast("double")
        parts += [F.count(name).alias(f"{name}_n"), F.avg(value).alias(f"{name}_mean"),
                  F.stddev_samp(value).alias(f"{name}_sd")]

    def rounded(column: Column) -> Column:
        return column if digits is None else F.bround(column, digits)

    fields = {
        name: {
            f"pct_present{suffix}": F.try_divide(F.col(f"{name}_n") * F.lit(100.0), F.col("_rows")),
            f"mean{suffix}": rounded(F.col(f"{name}_mean")),
            f"sd{suffix}": rounded(F.col(f"{name}_sd")),
        }
        for name in names
    }
    return long_form(df.agg(*parts), fields)


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows per class; a missing label is a class of its own."""
    return df.groupBy(label).agg(members().alias("n"))


def share_within(df: DataFrame, keys: Sequence[str], within: Sequence[str], count: str = "n",
                 share: str = "prop") -> DataFrame:
    """Rows per ``keys`` and their share of the rows of ``within`` (a subset of keys).

    The outer totals are a second aggregation of the counts, joined back with
    missing keys equal, so no outer group has to fit in one task.
    """
    counts = df.groupBy(*keys).agg(members().alias(count))
    totals = counts.groupBy(*within).agg(F.sum(count).alias("_total"))
    totals = totals.select(*[F.col(k).alias(f"_w_{k}") for k in within], "_total")
    joined = counts.join(totals, null_safe(within, [f"_w_{k}" for k in within]), "inner")
    return joined.select(*keys, count, (F.col(count) / F.col("_total")).alias(share))


def stratum_label_share(df: DataFrame, stratum: str, label: str) -> DataFrame:
    return share_within(df, [stratum, label], [stratum], share="share")


def conditional_means(df: DataFrame, means: dict[str, tuple[str, Column | None]]) -> DataFrame:
    """Means of columns over the rows where a condition holds, as (category, average)."""
    parts = []
    for name, (column, condition) in means.items():
        value = F.col(column).cast("double")
        parts.append(F.avg(value if condition is None else F.when(condition, value)).alias(name))
    row = df.agg(*parts)
    return unpivot(row, [], list(means), "category", "average")


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), variable, value)


def distinct_labels(df: DataFrame, label: str) -> DataFrame:
    """Number of distinct values, a missing label counting as one more."""
    groups = df.select(label).distinct()
    return groups.agg(
        F.count(label).alias("n_labels"),
        or_zero(F.max(F.col(label).isNull().cast("int"))).alias("has_missing"),
    )
