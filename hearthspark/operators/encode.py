"""Scaling, one-hot columns and the column-wise preprocessing pipeline."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthspark.operators.impute import apply_fill, fit_median

MISSING = "missing"


def fit_scale(df: DataFrame, names: Sequence[str], ddof: int = 0) -> dict[str, tuple[float, float]]:
    """(mean, sd) per column; ``ddof=0`` divides by n, ``ddof=1`` by n - 1."""
    spread = F.stddev_pop if ddof == 0 else F.stddev_samp
    parts = []
    for name in names:
        value = F.col(name).cast("double")
        parts += [F.avg(value).alias(f"{name}_mean"), spread(value).alias(f"{name}_sd")]
    row = df.agg(*parts).first()
    return {name: (row[f"{name}_mean"], row[f"{name}_sd"]) for name in names}


def apply_scale(df: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / sd; a column without spread is only centred."""
    return df.withColumns({
        name: (F.col(name).cast("double") - F.lit(mean)) / F.lit(sd if sd else 1.0)
        for name, (mean, sd) in fitted.items()
    })


def fit_levels(df: DataFrame, name: str) -> list[object]:
    """Sorted distinct values, one for each column that ``onehot_columns`` then makes.

    Where there are too many for columns, ``fit_preprocessor`` gives one sparse vector.
    """
    return sorted(row[0] for row in df.select(name).filter(F.col(name).isNotNull()).distinct().collect())


def onehot_columns(df: DataFrame, levels: dict[str, list[object]], drop_first: bool = False) -> DataFrame:
    """0/1 columns ``<name>_<level>`` in place of each column; unknown values give zeros."""
    made = [
        F.coalesce((F.col(name) == F.lit(level)).cast("int"), F.lit(0)).alias(f"{name}_{level}")
        for name, found in levels.items() for level in found[1 if drop_first else 0:]
    ]
    return df.select(*[name for name in df.columns if name not in levels], *made)


@dataclass(frozen=True)
class Preprocessor:
    """Median and scale for numbers, "missing" and one-hot for categories, in one vector."""

    numeric: list[str]
    categorical: list[str]
    fills: dict[str, object]
    scales: dict[str, tuple[float, float]]
    encoder: PipelineModel
    levels: dict[str, int]

    def transform(self, df: DataFrame, keep: Sequence[str], output: str = "features") -> DataFrame:
        inputs = [*self.numeric, *self.categorical]
        own = df.select(*keep, *[F.col(name).alias(f"_in_{name}") for name in inputs])
        ready = _branches(own, self.fills, self.scales, self.numeric, self.categorical)
        return self.encoder.transform(ready).select(*keep, F.col("_features").alias(output))


def _branches(df: DataFrame, fills: dict[str, object], scales: dict[str, tuple[float, float]],
              numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    def number(name: str) -> Column:
        mean, sd = scales[name]
        filled = F.coalesce(F.col(f"_in_{name}").cast("double"), F.lit(float(fills[name])))
        return (filled - F.lit(mean)) / F.lit(sd if sd else 1.0)

    texts = {f"_in_{n}": F.coalesce(F.col(f"_in_{n}").cast("string"), F.lit(MISSING)) for n in categorical}
    return df.withColumns({**{f"_in_{n}": number(n) for n in numeric}, **texts})


def fit_preprocessor(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> Preprocessor:
    """A category the training table lacks becomes all zeros."""
    fills: dict[str, object] = fit_median(df, numeric)
    scales = fit_scale(apply_fill(df, fills), numeric)
    own = df.select(*[F.col(name).alias(f"_in_{name}") for name in [*numeric, *categorical]])
    texts, index, hot = ([f"_in_{n}{end}" for n in categorical] for end in ("", "_index", "_hot"))
    stages = [
        StringIndexer(inputCols=texts, outputCols=index, stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=index, outputCols=hot),
    ] if categorical else []
    stages.append(VectorAssembler(inputCols=[*[f"_in_{n}" for n in numeric], *hot], outputCol="_features"))
    encoder = Pipeline(stages=stages).fit(_branches(own, fills, scales, numeric, categorical))
    sizes = [len(labels) for labels in encoder.stages[0].labelsArray] if categorical else []
    return Preprocessor(list(numeric), list(categorical), fills, scales, encoder, dict(zip(categorical, sizes)))


def assemble(df: DataFrame, names: Sequence[str], output: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """Feature columns as one vector column."""
    numbers = df.select(*keep, *[F.col(name).cast("double").alias(name) for name in names])
    return VectorAssembler(inputCols=list(names), outputCol=output).transform(numbers).select(*keep, output)
