"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthspark.operators.joins import unmatched_keys
from hearthspark.sources.schemas import HOUSEHOLDS_TEST, HOUSEHOLDS_TRAIN, PERSONS, PREDICTIONS

# How the survey files write infinities and missing cells.
CSV_FORMAT = {"header": "true", "nullValue": "", "positiveInf": "inf", "negativeInf": "-inf"}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system its address names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` from a CSV table, found by the names in its header.

    Their order in the file does not matter, and other columns are not read.
    An absent path or column is reported by name; a cell that is no value of
    its type is missing.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no table at {path}")
    text = spark.read.options(**CSV_FORMAT).csv(path)
    absent = [field.name for field in schema if field.name not in text.columns]
    if absent:
        raise ValueError(f"no column {', '.join(absent)} in {path}")
    return text.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])


def read_persons(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, PERSONS)


def read_households(spark: SparkSession, path: str, labelled: bool = True) -> DataFrame:
    """The training households, or with ``labelled`` off those without a label."""
    return read_csv(spark, path, HOUSEHOLDS_TRAIN if labelled else HOUSEHOLDS_TEST)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, PREDICTIONS)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header="true", nullValue="").csv(path)


def export_predictions(scored: DataFrame, households: DataFrame, path: str, prediction: str = "prediction",
                       key: str = "id") -> DataFrame:
    """Write (id, pobre) after checking that every household has exactly one row.

    Returns the written table as read back.
    """
    answer = scored.select(F.col(key), F.col(prediction).cast("int").alias("pobre"))
    odd = unmatched_keys(answer, households, key).limit(5).collect()
    if odd:
        raise ValueError(f"predictions and households differ, for example at {[r[key] for r in odd]}")
    write_csv(answer, path)
    return read_csv(scored.sparkSession, path, answer.schema)
