"""Projections, schema algebra and whole-table fills."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRACTIONAL = (T.DoubleType, T.FloatType)


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def project(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return require_columns(df, names).select(*names)


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the named columns; names the table lacks are no error."""
    return df.drop(*names)


def feature_names(df: DataFrame, excluded: Sequence[str]) -> list[str]:
    return [name for name in df.columns if name not in set(excluded)]


def common_columns(df: DataFrame, other: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Columns of ``df`` that ``other`` also has, plus ``keep``."""
    wanted = set(other.columns) | set(keep)
    return df.select(*[name for name in df.columns if name in wanted])


def align(df: DataFrame, schema: T.StructType, fill: object = None) -> DataFrame:
    """Exactly the columns of ``schema``, in its order; absent ones hold ``fill``."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(fill)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def numeric_names(df: DataFrame, include_boolean: bool = False, excluded: Sequence[str] = ()) -> list[str]:
    kinds = (T.NumericType, T.BooleanType) if include_boolean else (T.NumericType,)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in set(excluded)]


def as_numbers(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(n).cast("int").alias(n) if isinstance(df.schema[n].dataType, T.BooleanType)
                       else F.col(n) for n in names])


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def tag(df: DataFrame, name: str, value: object) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def union_tagged(first: DataFrame, second: DataFrame, name: str, allow_missing: bool = True) -> DataFrame:
    """Both tables one below the other, told apart by a 0/1 column."""
    return tag(first, name, 0).unionByName(tag(second, name, 1), allowMissingColumns=allow_missing)


def labeled(df: DataFrame, label: str) -> DataFrame:
    return df.filter(F.col(label).isNotNull())


def fill_constant(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.na.fill(values)


def fill_all(df: DataFrame, number: int = 0) -> DataFrame:
    """One constant in every missing cell, written as text or false where the type asks."""
    kinds = {T.StringType: str(number), T.BooleanType: bool(number)}
    return df.na.fill({f.name: kinds.get(type(f.dataType), number) for f in df.schema.fields})


def drop_incomplete_rows(df: DataFrame) -> DataFrame:
    """Rows without any missing cell, NaN counting as missing.

    One condition per column: a single condition over many columns makes the
    optimizer's constraint sets grow exponentially in later projections.
    """
    present = [F.col(name).isNotNull() for name in df.columns]
    present += [~F.isnan(name) for name in fractional_names(df)]
    return df.filter(reduce(lambda a, b: a & b, present))


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Without the columns that are missing in every row (one pass of counts)."""
    counts = df.agg(*[F.count(name).alias(name) for name in df.columns]).first()
    return df.drop(*[name for name in df.columns if counts[name] == 0])


def rescale(df: DataFrame, names: Sequence[str], divisor: float = 1e6) -> DataFrame:
    return df.withColumns({name: F.col(name) / F.lit(divisor) for name in names})


def is_infinite(name: str) -> Column:
    return F.col(name).isin(float("inf"), float("-inf"))


def fractional_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, FRACTIONAL)]


def replace_infinite(df: DataFrame, names: Sequence[str], value: float | None = None) -> DataFrame:
    return df.withColumns({
        name: F.when(is_infinite(name), F.lit(value).cast("double")).otherwise(F.col(name)) for name in names
    })


def per_column(df: DataFrame, names: Sequence[str], make: Callable[[str], Column]) -> DataFrame:
    """Apply one expression builder to several columns, leaving the rest alone."""
    return df.withColumns({name: make(name) for name in names})


def recode(df: DataFrame, name: str, labels: dict[object, str], to: str) -> DataFrame:
    """A column of the labels of a column's codes; a code without a label is missing."""
    code = F.lit(None).cast("string")
    for value, label in reversed(labels.items()):
        code = F.when(F.col(name) == F.lit(value), F.lit(label)).otherwise(code)
    return df.withColumn(to, code)
