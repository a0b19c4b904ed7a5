"""Line deduplication over batches of documents, with the lines seen so far in levelled sorted runs of hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField

from hearthspark.llm.common import append, texts
from hearthspark.llm.storage import SortedRun, Stage

MIN_CHARS = 10
BLANKS = b" \t\n\x0b\x0c\r"

# Batches of one call, and the runs of a level that are compacted into one of the next.
BATCHES = 4
FAN_IN = 2

KEY = ("h1", "h2")


def line_key(line: bytes) -> bytes:
    """The line without white space at its ends, A-Z lower-cased."""
    return line.strip(BLANKS).lower()


def key_hash(key: bytes) -> tuple[int, int]:
    """128 bits of a key as two signed longs."""
    digest = xxhash.xxh3_128_digest(key)
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def long_enough(key: bytes, least: int) -> bool:
    if len(key) < least:
        return False
    return len(key) >= 4 * least or sum(byte & 0xC0 != 0x80 for byte in key) >= least


def hashed_lines(docs: DataFrame, least: int = MIN_CHARS) -> DataFrame:
    """doc_id and the distinct hashes of its long enough line keys, one row per key and row of ``docs``."""

    def make() -> Callable[..., Sequence[pa.Array]]:
        def compute(column: pa.Array) -> Sequence[pa.Array]:
            digests: list[bytes] = []
            ends = [0]
            for text in texts(column):
                keys = {key for key in map(line_key, text.split(b"\n")) if long_enough(key, least)}
                digests += [xxhash.xxh3_128_digest(key) for key in keys]
                ends.append(len(digests))
            pairs = np.frombuffer(b"".join(digests), dtype=">i8").astype(np.int64).reshape(-1, 2)
            offsets = pa.array(ends, pa.int32())
            return [pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(pairs[:, i]))) for i in (0, 1)]

        return compute

    fields = [StructField(name, ArrayType(LongType())) for name in KEY]
    listed = append(docs.where(F.col("doc_id").isNotNull()), make, fields, ["text"], ["doc_id"], measure="text")
    return (listed.select("doc_id", F.explode(F.arrays_zip(*KEY)).alias("key"))
            .select("doc_id", *[F.col(f"key.{name}") for name in KEY]))


class LineStore:
    """The line keys of all documents admitted so far, as sorted runs on levels.

    A batch adds one run of the keys that no earlier run has. When a level
    holds ``fan_in`` runs they are merged into one run of the next level, so n
    batches leave about log n runs and a key is rewritten about log n times.
    Batches must come in ascending, disjoint ranges of doc_id; then the first
    batch with a key holds its smallest document.
    """

    def __init__(self, spark: SparkSession, buckets: int, fan_in: int = FAN_IN) -> None:
        self.spark, self.buckets, self.fan_in = spark, buckets, fan_in
        self.levels: list[list[SortedRun]] = []

    def runs(self) -> list[SortedRun]:
        return [run for level in self.levels for run in level]

    def admit(self, lines: DataFrame, last: bool = False) -> tuple[DataFrame, SortedRun]:
        """The (doc_id, key) rows of a batch whose line has an earlier document, and the run that says so.

        The batch's keys are aggregated to one row each before they meet the
        runs, so that a key in a third of all documents is one row there. The
        ``last`` batch starts no compaction.
        """
        found = lines.groupBy(*KEY).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("latest"))
        seen = F.lit(False)
        for i, run in enumerate(self.runs()):
            known = run.df.where(~F.col("seen")).select(*KEY, F.lit(True).alias(f"in_{i}"))
            found = found.join(known, list(KEY), "left")
            seen = seen | F.coalesce(f"in_{i}", F.lit(False))
        own = SortedRun(found.select(*KEY, "first", "latest", seen.alias("seen")), KEY, self.buckets)
        # Read as plain files: where both sides are shuffled, a line in very many documents can be split.
        rows = self.spark.read.schema(own.df.schema).parquet(own.path)
        repeated = rows.where(F.col("seen") | (F.col("first") < F.col("latest"))).select(*KEY, "first", "seen")
        dropped = (lines.join(repeated, list(KEY)).where(F.col("seen") | (F.col("doc_id") > F.col("first")))
                   .select("doc_id", *KEY))
        self.add(own, 0, compact=not last)
        return dropped, own

    def add(self, run: SortedRun, level: int, compact: bool) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)

        if compact and len(self.levels[level]) > self.fan_in:
            # All but the newest, which the caller still reads.
            old, self.levels[level] = self.levels[level][:-1], [run]
            rows = reduce(DataFrame.unionByName, [x.df.where(~F.col("seen")) for x in old])
            merged = SortedRun(rows, KEY, self.buckets)
            for x in old:
                x.delete()
            self.add(merged, level + 1, compact)

    def delete(self) -> None:
        for run in self.runs():
            run.delete()
        self.levels = []


def ascending_batches(docs: DataFrame, batches: int) -> list[int]:
    """Upper bounds of all but the last batch: quantiles of doc_id over all rows."""
    if batches < 2:
        return []
    shares = [i / batches for i in range(1, batches)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares, 1000).alias("bounds")).first()["bounds"]
    return sorted(set(bounds or []))


def dropped_lines(docs: DataFrame, least: int = MIN_CHARS, batches: int = BATCHES) -> Stage:
    """doc_id and the hashes of the line keys it loses, one row per document that loses any."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = ascending_batches(docs, batches)
    number = F.lit(0)
    for bound in bounds:
        number = number + (F.col("doc_id") > bound).cast("int")
    lines = Stage(hashed_lines(docs, least).withColumn("batch", number), "lines", by=["batch"])
    store = LineStore(spark, buckets)
    found: list[Stage] = []
    for i in range(len(bounds) + 1):
        rows, _ = store.admit(lines.df.where(F.col("batch") == i).drop("batch"), last=i == len(bounds))
        # Of a document's lines, all meet in one row: no more than its own text held.
        found.append(Stage(rows.groupBy("doc_id").agg(F.collect_set(F.struct(*KEY)).alias("keys")), "dropped"))
    whole = found[0] if len(found) == 1 else Stage(reduce(DataFrame.unionByName, [x.df for x in found]), "dropped")
    for stage in [lines, *(found if len(found) > 1 else [])]:
        stage.delete()
    store.delete()
    return whole


def kept_lines(text: bytes, keys: frozenset[tuple[int, int]]) -> tuple[bytes, int, int]:
    """The kept text, the number of lines and the number of dropped ones."""
    lines = text.split(b"\n")
    if not keys:
        return text, len(lines), 0
    kept = [line for line in lines if key_hash(line_key(line)) not in keys]
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def dedup_lines(docs: DataFrame, least: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """``docs`` with its text reduced to the kept lines, and n_lines, n_dropped, kept_sha256.

    A line's key is the line without [\\x20\\x09-\\x0D] at its ends, A-Z
    lower-cased. A key of at least ``least`` code points that occurs in two or
    more documents keeps its lines only in the document with the smallest
    doc_id, there all of them. All other lines stay. A null text is one empty
    line. Rows with the same doc_id are one document that holds the lines of
    all its rows; rows without a doc_id keep all their lines and hold no key.
    """
    dropped = dropped_lines(docs, least, batches).df
    joined = docs.join(dropped.withColumnRenamed("keys", "dropped keys"), "doc_id", "left").select(
        *docs.columns, "dropped keys")

    def make() -> Callable[..., Sequence[pa.Array]]:
        def compute(column: pa.Array, lists: pa.Array) -> Sequence[pa.Array]:
            kept, counts, losses = [], [], []
            for text, keys in zip(texts(column), lists.to_pylist(), strict=True):
                left, n_lines, n_dropped = kept_lines(text, frozenset((x["h1"], x["h2"]) for x in keys or ()))
                kept.append(left)
                counts.append(n_lines)
                losses.append(n_dropped)
            digests = [hashlib.sha256(left).hexdigest() for left in kept]
            return (pa.array(kept, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()),
                    pa.array(losses, pa.int64()), pa.array(digests, pa.string()))

        return compute

    fields = [StructField("text", StringType()), StructField("n_lines", LongType()),
              StructField("n_dropped", LongType()), StructField("kept_sha256", StringType())]
    keep = [name for name in docs.columns if name != "text"]
    return append(joined, make, fields, ["text", "dropped keys"], keep, measure="text")




def keep_lines(docs: DataFrame, least: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """``docs`` with the lines kept in ``text`` and, where there is such a column, their code points in ``n_chars``."""
    kept = dedup_lines(docs, least, batches)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)
