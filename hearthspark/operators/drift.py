"""Two-table comparisons per numeric column."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthspark.functions.pvalues import kolmogorov_p, smirnov_tail, student_p
from hearthspark.operators.joins import lookup
from hearthspark.operators.ordering import running_totals
from hearthspark.operators.profile import long_form
from hearthspark.session import materialize


# Product of two sample sizes from which on the limit law gives p.
EXACT_BELOW = 10_000


def _long(first: DataFrame, second: DataFrame, names: Sequence[str]) -> DataFrame:
    def side(df: DataFrame, mark: int) -> DataFrame:
        numbers = df.select(*[F.col(n).cast("double").alias(n) for n in names])
        return numbers.unpivot([], list(names), "variable", "value").withColumn("side", F.lit(mark))

    return side(first, 0).unionByName(side(second, 1)).filter(F.col("value").isNotNull())


def kolmogorov_smirnov(first: DataFrame, second: DataFrame, names: Sequence[str], exact_below: int = EXACT_BELOW
                       ) -> DataFrame:
    """Largest distance of the two distribution functions and its p, per variable.

    p is exact, ties included, for a variable whose numbers of values in both
    tables have a product below ``exact_below``, and asymptotic for any other.
    """
    counts = materialize(_long(first, second, names).groupBy("variable", "value").agg(
        F.count_if(F.col("side") == 0).alias("a"), F.count_if(F.col("side") == 1).alias("b")
    ))
    ordered = running_totals(counts, "value", ["a", "b"], by=["variable"], written=True)
    # One row for each variable.
    listed = counts.groupBy("variable").agg(F.sum("a").alias("n_a"), F.sum("b").alias("n_b")).collect()
    sizes = first.sparkSession.createDataFrame(listed, "variable string, n_a long, n_b long")
    shares = lookup(ordered, sizes, ["variable"]).filter("n_a > 0 and n_b > 0")
    gap = F.abs((F.col("a_before") + F.col("a")) / F.col("n_a") - (F.col("b_before") + F.col("b")) / F.col("n_b"))
    widest = shares.groupBy("variable").agg(F.max(gap).alias("d"), F.max("n_a").alias("n_a"), F.max("n_b").alias("n_b"))
    limit = kolmogorov_p(F.col("d"), F.col("n_a"), F.col("n_b"))
    small = [row["variable"] for row in listed if 0 < row["n_a"] * row["n_b"] < exact_below]
    if not small:
        return widest.withColumn("p_value", limit)
    # Such a variable has fewer values than ``exact_below``.
    exact = counts.filter(F.col("variable").isin(small)).groupBy("variable").applyInPandas(
        _exact_p, "variable string, p_exact double")
    return widest.join(exact, "variable", "left").withColumn("p_value", F.coalesce("p_exact", limit)).drop("p_exact")


def _exact_p(counts: pd.DataFrame) -> pd.DataFrame:
    ordered = counts.sort_values("value")
    return pd.DataFrame({"variable": ordered["variable"].head(1),
                         "p_exact": [smirnov_tail(ordered["a"].to_numpy(), ordered["b"].to_numpy())]})


def _sides(first: DataFrame, second: DataFrame, names: Sequence[str]) -> DataFrame:
    def side(df: DataFrame, mark: str) -> DataFrame:
        return df.select(F.lit(mark).alias("_side"), *[F.col(n).cast("double").alias(n) for n in names])

    return side(first, "a").unionByName(side(second, "b"))


def _moments(rows: DataFrame, part: str, names: Sequence[str], sides: dict[str, str]) -> DataFrame:
    """Per variable rows, n, mean and sample variance of each part, as rows_a, n_a, m_a, v_a and so on.

    One grouped pass gives one row for each part, and all else follows from
    those rows. ``sides`` maps a suffix to a value of ``part``.
    """
    parts = [F.count(F.lit(1)).alias("_rows")]
    for n in names:
        value = F.col(n).cast("double")
        parts += [F.count(n).alias(f"{n}_n"), F.avg(value).alias(f"{n}_m"), F.var_samp(value).alias(f"{n}_v")]
    grouped = rows.groupBy(F.col(part).alias("_part")).agg(*parts)
    wide = grouped.agg(*[
        F.max(F.when(F.col("_part") == value, F.col(name))).alias(f"{name}_{side}")
        for side, value in sides.items() for name in grouped.columns[1:]])
    return long_form(wide, {n: {f"{stat}_{side}": F.col(f"_rows_{side}" if stat == "rows" else f"{n}_{stat}_{side}")
                                for side in sides for stat in ("rows", "n", "m", "v")} for n in names})


def _welch(both: DataFrame) -> DataFrame:
    """t and df beside the moments."""
    ea, eb = F.try_divide("v_a", "n_a"), F.try_divide("v_b", "n_b")
    spread = ea + eb
    t = F.try_divide(F.col("m_a") - F.col("m_b"), F.sqrt(spread))
    df = F.try_divide(spread * spread,
                      F.try_divide(ea * ea, F.col("n_a") - 1) + F.try_divide(eb * eb, F.col("n_b") - 1))
    return both.withColumns({"t": t, "df": df})


def welch_t(first: DataFrame, second: DataFrame, names: Sequence[str], with_p: bool = True) -> DataFrame:
    """Unequal-variance t, degrees of freedom and p, per variable."""
    both = _moments(_sides(first, second, names), "_side", names, {"a": "a", "b": "b"})
    result = _welch(both).select("variable", "t", "df")
    return result.withColumn("p_value", student_p(F.col("t"), F.col("df"))) if with_p else result


def compare_parts(rows: DataFrame, part: str, names: Sequence[str], first: str = "train", second: str = "test",
                  digits: int = 2) -> DataFrame:
    """Non-missing %, mean and sd of two parts of a table side by side with the t-test p, from one grouped pass."""
    both = _welch(_moments(rows, part, names, {"a": first, "b": second}))
    shown = [column for side, name in (("a", first), ("b", second)) for column in (
        F.try_divide(F.col(f"n_{side}") * F.lit(100.0), F.col(f"rows_{side}")).alias(f"pct_present_{name}"),
        F.bround(f"m_{side}", digits).alias(f"mean_{name}"), F.bround(F.sqrt(f"v_{side}"), digits).alias(f"sd_{name}"))]
    return both.select("variable", *shown, F.round(student_p(F.col("t"), F.col("df")), 3).alias("p_value"))


def compare_tables(first: DataFrame, second: DataFrame, names: Sequence[str], first_name: str = "train",
                   second_name: str = "test") -> DataFrame:
    """The same for two tables."""
    rows = _sides(first, second, names).replace({"a": first_name, "b": second_name}, subset=["_side"])
    return compare_parts(rows, "_side", names, first_name, second_name)


def top_drift(table: DataFrame, k: int = 5) -> DataFrame:
    return table.orderBy(F.desc("d"), "variable").limit(k)
