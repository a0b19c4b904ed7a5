"""Joins against small tables, with the smallness checked rather than assumed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOOKUP_LIMIT = 100_000
LOOKUP_BYTES = 32 << 20


def settle(table: DataFrame, limit: int = LOOKUP_LIMIT) -> DataFrame | None:
    """The same rows as a local table if there are at most ``limit`` of LOOKUP_BYTES at most, else None.

    At most ``limit + 1`` rows reach the driver. A local table has a size
    Spark knows exactly, and using it twice does not compute it twice.
    """
    rows = table.limit(limit + 1).toArrow()
    if rows.num_rows > limit or rows.nbytes > LOOKUP_BYTES:
        return None
    return table.sparkSession.createDataFrame(rows, schema=table.schema)


def null_safe(left: Sequence[str], right: Sequence[str]) -> Column:
    pairs = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)]
    return reduce(lambda x, y: x & y, pairs)


def lookup(df: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left",
           limit: int = LOOKUP_LIMIT) -> DataFrame:
    """Join ``table`` (one row per key) onto ``df``; missing keys match missing keys.

    A table within the limit is broadcast, so ``df`` is not shuffled. A larger
    one is joined by shuffle, where adaptive execution splits a hot key of ``df``.
    """
    small = settle(table, limit)
    side = F.broadcast(small) if small is not None else table
    inner = {name: f"_key_{name}" for name in on}
    side = side.select(*[F.col(n).alias(inner.get(n, n)) for n in side.columns])
    return df.join(side, null_safe(on, [inner[n] for n in on]), how).drop(*inner.values())


def join_one_to_many(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join of ``table`` (one row per key) onto rows among which a key may be hot.

    Adaptive execution splits a hot key only where the join itself asked for
    both exchanges. A table that a grouping left partitioned by the key would
    be joined without one; the null-safe form makes Spark exchange it again.
    """
    keyed = table.withColumnRenamed(key, "_key")
    return rows.join(keyed, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def join_household_columns(persons: DataFrame, households: DataFrame, columns: Sequence[str],
                           key: str = "id") -> DataFrame:
    """Household columns on every person row (many persons to one household)."""
    return join_one_to_many(persons, households.select(key, *columns), key)


def group_value_on_rows(df: DataFrame, values: dict[str, Column], by: str = "id") -> DataFrame:
    """Aggregates of the group repeated on each of its rows.

    A window would bring a whole group to one task. Grouping first combines on
    the map side, and the join back can split a hot group.
    """
    return join_one_to_many(df, df.groupBy(by).agg(*[value.alias(name) for name, value in values.items()]), by)


def reattach_label(sample: DataFrame, source: DataFrame, label: str, key: str = "id") -> DataFrame:
    """Bring the label back by key, never by row position."""
    return sample.join(source.select(key, label), key, "left")


def unmatched_keys(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """Keys whose row counts differ between two tables, in one shuffle."""
    tagged = left.select(key, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        right.select(key, F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    counts = tagged.groupBy(key).agg(F.sum("a").alias("n_left"), F.sum("b").alias("n_right"))
    return counts.filter("n_left <> n_right")
