"""Aggregates with the two readings of a missing answer.

Two-valued: a missing answer is "no". Three-valued: "yes" if any row says yes,
unknown if none does and some row is missing, else "no".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def members() -> Column:
    return F.count(F.lit(1))


def any_two_valued(condition: Column) -> Column:
    return F.coalesce(F.max(condition.cast("int")), F.lit(0))


def any_three_valued(condition: Column) -> Column:
    return (
        F.when(F.max(condition.cast("int")) == 1, F.lit(1))
        .when(F.count(condition) < members(), F.lit(None).cast("int"))
        .otherwise(F.lit(0))
    )


def share_of_known(condition: Column) -> Column:
    """Mean of the condition over rows where it is known; NULL if none is."""
    return F.avg(condition.cast("double"))


def share_of_all(condition: Column) -> Column:
    """Rows where the condition holds over all rows, missing rows included."""
    return F.count_if(condition) / members()


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """NULL instead of an ANSI error where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))
