"""Packing by powers of two: a document is split into pieces of binary lengths, and equal lengths form buckets."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from hearthspark.llm.common import append, task_state, texts, tidy
from hearthspark.llm.storage import Stage
from hearthspark.llm.tokens import encoder

MAX_TOKENS = 1024
END_ID = 0

PIECE = StructType([StructField(name, LongType()) for name in ("start", "length", "ids_crc32", "doc_tokens")])


def binary_pieces(tokens: int, most: int = MAX_TOKENS) -> list[tuple[int, int]]:
    """(start, length) of whole sequences, then one piece for each binary digit of the rest, longest first."""
    pieces = [(start, most) for start in range(0, tokens - most + 1, most)]
    start = tokens // most * most
    length = most
    while start < tokens:
        length //= 2
        if tokens - start >= length:
            pieces.append((start, length))
            start += length
    return pieces


def document_pieces(docs: DataFrame, keep: Sequence[str], text: str, tokenizer: str, most: int, end_id: int
                    ) -> DataFrame:
    """``keep`` and one row for each piece of each document."""
    state = "ids", tokenizer

    def make() -> Callable[[pa.Array], Sequence[pa.Array]]:
        encode = task_state(state, lambda: encoder(tokenizer))
        end = end_id.to_bytes(4, "little")
        cuts: dict[int, list[tuple[int, int]]] = {}

        def compute(column: pa.Array) -> Sequence[pa.Array]:
            columns: list[list[int]] = [[], [], [], []]
            ends = [0]
            for data in encode([x.decode() for x in texts(column)]):
                ids = data + end
                tokens = len(ids) // 4
                pieces = cuts.get(tokens) or cuts.setdefault(tokens, binary_pieces(tokens, most))
                for start, length in pieces:
                    crc = zlib.crc32(memoryview(ids)[4 * start:4 * (start + length)])
                    for values, value in zip(columns, (start, length, crc, tokens), strict=True):
                        values.append(value)
                ends.append(len(columns[0]))
            rows = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in columns], names=PIECE.fieldNames())
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)]

        return compute

    listed = append(docs, make, [StructField("pieces", ArrayType(PIECE))], [text], keep, measure=text,
                    state=state)
    return listed.select(*keep, F.explode("pieces").alias("piece")).select(*keep, "piece.*")


def numbered(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` in the order of ``order`` with a gapless number from 0.

    Rows are dealt by ranges and sorted within them; the range sizes, one
    number for each partition, give the first number of each range. Equal rows
    may swap numbers, nothing else depends on a task that runs again: the
    sorted rows are written before they are counted.
    """

    def count_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            place = pa.array(range(seen, seen + batch.num_rows), pa.int64())
            seen += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, place], names=[*batch.schema.names, "place"])

    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    schema = StructType([*dealt.schema.fields, StructField("place", LongType())])
    written = Stage(dealt.mapInArrow(tidy(count_up), schema), "numbered").df
    sizes = sorted((row["part"], row["n"]) for row in written.groupBy("part").agg(F.count("*").alias("n")).collect())
    firsts, total = [], 0
    for part, n in sizes:
        firsts.append((part, total))
        total += n
    starts = StructType([StructField("part", IntegerType()), StructField("first", LongType())])
    # As many rows as there are partitions.
    small = F.broadcast(rows.sparkSession.createDataFrame(firsts, starts))
    return (written.join(small, "part").withColumn(name, F.col("first") + F.col("place"))
            .drop("part", "place", "first"))


def pack(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", tokenizer: str = "byte_bpe_50k.json",
         most: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """One row for each piece: ``keep``, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids, with ``end_id`` after them, are cut into whole
    sequences of ``most`` ids and one piece of a power of two for each binary
    digit of the rest. Each piece is a sequence of its own in the bucket of
    its length, so no sequence crosses documents and none is padded. Sequences
    are numbered from the longest bucket to the shortest, so a bucket is one
    range of sequence_id. ``most`` is a power of two. A null or empty text has
    the end id alone. Every row of ``docs`` is a document of its own.
    """
    if most < 1 or most & (most - 1):
        raise ValueError(f"sequences of {most} tokens have no binary pieces")
    pieces = document_pieces(docs, keep, text, tokenizer, most, end_id)
    # Ranges are found from a sample of their input: without a written copy the texts would be encoded twice.
    pieces = Stage(pieces, "pieces").df
    bucket = [F.desc("length"), *[F.asc(f"`{name}`") for name in keep], F.asc("start"), F.asc("ids_crc32")]
    return numbered(pieces, bucket, "sequence_id").withColumn("offset", F.lit(0).cast("long"))
