"""Small tables with the cases every operator has to handle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, texts: list[tuple[int | None, str | None]], clash: str = "") -> DataFrame:
    """Documents with these (doc_id, text); ``clash`` names an extra column."""
    rows = [(i, text, "en", "s", len(text or "")) for i, text in texts]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", f"'mine' as `{clash}`") if clash else df


def given(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.parquet(f"{SMALL}/{name}.parquet")
