"""From raw documents to packed training sequences, in five stages.

Each stage gets what the one before kept, written as Parquet and read again.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hearthspark.llm import decontaminate, langid, linededup, packing, simhash
from hearthspark.llm.common import prepared, table
from hearthspark.llm.storage import Stage

# Bytes of an Arrow batch on its way to a worker. Five stages share the executors' memory, and a thousand long texts at
# once would take a good part of it.
BATCH_BYTES = 2 << 20


def bounded(spark: SparkSession) -> SparkSession:
    """The session with batches of bounded bytes."""
    prepared(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language."""
    bounded(spark)
    return langid.keep_accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each long enough line only in the first document that has it."""
    bounded(spark)
    return linededup.keep_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    bounded(spark)
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.drop_contaminated(docs, table(bounded(spark), sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    bounded(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

# SQL can't express the language model, the fingerprints and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = Stage(stage(spark, docs, sf_dir), name).df
    return last(spark, docs, sf_dir)
