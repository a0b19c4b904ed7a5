"""Table preparation as compositions of the single operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthspark.operators import columns as c
from hearthspark.operators.impute import apply_fill, fit_median, fit_mode
from hearthspark.sources.survey import LABEL, LEAKY, SPARSE


@dataclass(frozen=True)
class Prepared:
    """What the training table taught: fill values and the columns to end up with."""

    fills: dict[str, object]
    schema: T.StructType


def fit_prepare(train: DataFrame, label: str = LABEL, leaky: Sequence[str] = LEAKY, key: str = "id") -> Prepared:
    """Medians of the numeric and modes of the text columns of the labeled training rows.

    A column without any value there teaches nothing and leaves both tables.
    """
    rows = c.drop_empty_columns(c.labeled(c.drop_columns(train, leaky), label))
    numeric = c.numeric_names(rows, excluded=[label, key])
    texts = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.StringType) and f.name != key]
    fills = {**fit_median(rows, numeric), **(fit_mode(rows, texts) if texts else {})}
    return Prepared(fills, apply_fill(rows, fills).schema)


def apply_prepare(df: DataFrame, fitted: Prepared, label: str = LABEL, leaky: Sequence[str] = LEAKY) -> DataFrame:
    """Drop leaky columns, require the label where the table has one, fill, align."""
    rows = c.drop_columns(df, leaky)
    if label in rows.columns:
        rows = c.labeled(rows, label)
    return c.align(apply_fill(rows, fitted.fills), fitted.schema)


def ready_table(df: DataFrame, other: DataFrame, label: str = LABEL, sparse: Sequence[str] = SPARSE) -> DataFrame:
    """Columns shared with ``other`` plus the label, without the sparse ones, missing cells 0."""
    keep = [label] if label in df.columns else []
    shared = c.drop_columns(c.common_columns(df, other, keep=keep), sparse)
    return c.drop_incomplete_rows(c.fill_all(shared))


def ready_checks(df: DataFrame) -> DataFrame:
    """Rows, columns, missing cells and infinite cells in one pass."""
    missing = sum((F.count_if(F.col(n).isNull()) for n in df.columns), F.lit(0))
    infinite = sum((F.count_if(c.is_infinite(n)) for n in c.fractional_names(df)), F.lit(0))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"),
        missing.cast("long").alias("missing_cells"), infinite.cast("long").alias("infinite_cells"),
    )
