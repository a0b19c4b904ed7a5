"""Written stages: tables in the shared folder that cut lineage and can be deleted once read for the last time."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from hearthspark.session import fresh_path


class Stage:
    """A DataFrame written once to the shared folder. Lost executors cost no more than their running tasks."""

    def __init__(self, df: DataFrame, label: str = "stage", by: Sequence[str] = ()) -> None:
        self.spark = df.sparkSession
        self.path = fresh_path(self.spark, label)
        df.write.partitionBy(*by).parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def delete(self) -> None:
        delete(self.spark, self.path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared store through Spark's own file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class SortedRun:
    """A bucketed table sorted within its buckets: joined on its keys it is neither shuffled nor written again."""

    def __init__(self, df: DataFrame, keys: Sequence[str], buckets: int) -> None:
        self.spark, self.keys = df.sparkSession, list(keys)
        self.name = f"run_{uuid.uuid4().hex}"
        self.path = fresh_path(self.spark, "run")
        (df.repartition(buckets, *self.keys).write.format("parquet").bucketBy(buckets, *self.keys)
         .sortBy(*self.keys).option("path", self.path).saveAsTable(self.name))
        self.df = self.spark.table(self.name)

    def delete(self) -> None:
        self.spark.sql(f"drop table if exists {self.name}")
        delete(self.spark, self.path)
