"""Near-duplicate documents by SimHash fingerprints and pigeonring filtering."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from hearthspark.llm.common import append, texts, tidy
from hearthspark.llm.components import components
from hearthspark.llm.storage import Stage

SHINGLE = 4
SEED = 42
MAX_BITS = 4

# (first bit, number of bits) of the segments of the ring, and the parts a segment falls into for keys.
SEGMENTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
PARTS = 4
# Fingerprints compared in one tile of a bucket; a larger bucket is cut into tiles, and each pair of tiles compared.
TILE = 4096
# Shingles hashed at once.
PORTION = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits, each set if over half of the shingles' XXH64 values have it set. No words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    starts = [0]
    for word in words:
        starts.append(starts[-1] + len(word) + 1)
    number = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for low in range(0, number, PORTION):
        high = min(number, low + PORTION)
        ends = starts[low + min(shingle, len(words)):high + min(shingle, len(words))]
        hashes = np.array([digest(line[a:b - 1], seed) for a, b in zip(starts[low:high], ends, strict=True)],
                          dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > number).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep``, bits (the fingerprint as a signed long) and fingerprint (16 lowercase hex digits)."""

    def make() -> Callable[[pa.Array], Sequence[pa.Array]]:
        def compute(column: pa.Array) -> Sequence[pa.Array]:
            found = [fingerprint(data) for data in texts(column)]
            return (pa.array(np.array(found, dtype=np.uint64).view(np.int64)),
                    pa.array([f"{x:016x}" for x in found], pa.string()))

        return compute

    return append(docs, make, [StructField("bits", LongType()), StructField("fingerprint", StringType())], [text],
                  keep, measure=text)


def part_masks(segment: int) -> list[int]:
    """For each part of a segment the mask of all its other bits."""
    first, bits = SEGMENTS[segment]
    edges = [first + bits * i // PARTS for i in range(PARTS + 1)]
    whole = ((1 << bits) - 1) << first
    return [whole & ~(((1 << (high - low)) - 1) << low) for low, high in zip(edges, edges[1:], strict=False)]


def chain_keys(bits: Column) -> Column:
    """Bucket keys of a fingerprint, one for each start of a chain and part of its second segment.

    Pigeonring principle: where at most 4 bits of 5 segments on a ring differ,
    some chain of segments starts with 0 differing bits, and has at most
    floor(4/5 n) in its first n segments for every n. So its first segments
    are equal and its second ones differ in one bit at most, in one part: two
    such fingerprints share the key that leaves this part out.
    """
    keys = []
    for start, (first, size) in enumerate(SEGMENTS):
        following = (start + 1) % len(SEGMENTS)
        equal = F.shiftrightunsigned(bits, first).bitwiseAND(F.lit((1 << size) - 1))
        low = SEGMENTS[following][0]
        for part, mask in enumerate(part_masks(following)):
            rest = F.shiftrightunsigned(bits, low).bitwiseAND(F.lit(mask >> low))
            keys.append((F.lit(start * PARTS + part) * F.lit(1 << 26) + F.shiftleft(equal, 13) + rest).cast("long"))
    return F.array(*keys)


def chain_masks(start: int) -> list[tuple[np.uint64, int]]:
    """For chains from ``start``: the bits of its first 2, 3, ... segments and how many of them may differ."""
    steps, mask = [], 0
    for n in range(1, len(SEGMENTS) + 1):
        first, bits = SEGMENTS[(start + n - 1) % len(SEGMENTS)]
        mask |= ((1 << bits) - 1) << first
        steps.append((np.uint64(mask), MAX_BITS * n // len(SEGMENTS)))
    return steps


def forest(values: np.ndarray, steps: Sequence[tuple[np.uint64, int]]) -> list[tuple[int, np.ndarray]]:
    """Trees (root, other members) over fingerprints linked within their budgets.

    From each root the tree grows by all it links to that no tree has yet, so
    a tight group of n costs far fewer than n² comparisons and n - 1 links.
    """
    trees = []
    left = values
    while len(left) > 1:
        root, left = left[0], left[1:]
        grown = [np.array([root], dtype=np.uint64)]
        waiting = [root]
        while waiting and len(left):
            differing = left ^ waiting.pop()
            near = np.arange(len(left))
            # The last step covers the whole ring: the full Hamming check of what the chains leave.
            for mask, budget in steps:
                near = near[np.bitwise_count(differing[near] & mask) <= budget]
                if not len(near):
                    break
            if len(near):
                found = left[near]
                grown.append(found)
                waiting.extend(found)
                left = np.delete(left, near)
        members = np.concatenate(grown)
        if len(members) > 1:
            trees.append((root, members[1:]))
    return trees


def links(distinct: DataFrame, tile: int = TILE) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints connected by 4 or fewer differing bits.

    Each bucket gives the links of a spanning forest, not its pairs. A bucket
    of more than ``tile`` fingerprints is cut by hash into tiles, and every
    pair of tiles is a task of its own, so memory is bounded whatever a
    bucket holds and no link is lost.
    """
    keyed = distinct.select("bits", F.explode(chain_keys(F.col("bits"))).alias("key"))
    counted = Stage(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > tile), "hot").df
    tiles = F.ceil(F.coalesce("n", F.lit(1)) / tile).cast("int")
    own = F.pmod(F.xxhash64("bits", F.lit(1)), F.col("tiles")).cast("int")
    placed = (keyed.join(counted, "key", "left").withColumn("tiles", tiles).withColumn("own", own)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
              .select("bits", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")))
    listed = (placed.groupBy("key", "low", "high").agg(F.collect_list("bits").alias("members"))
              .where(F.size("members") > 1).select("key", "members"))
    schema = StructType([StructField("a", LongType()), StructField("b", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chains = [chain_masks(start) for start in range(len(SEGMENTS))]
        for batch in batches:
            starts = (batch.column(0).to_numpy() >> 26) // PARTS
            column = batch.column(1)
            ends = column.offsets.to_numpy()
            members = column.values.to_numpy().view(np.uint64)
            roots: list[np.ndarray] = []
            found: list[np.ndarray] = []
            for i, start in enumerate(starts):
                for root, others in forest(members[ends[i]:ends[i + 1]], chains[start]):
                    roots.append(np.full(len(others), root))
                    found.append(others)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).view(np.int64)) for x in (roots, found)], names=["a", "b"])

    return listed.mapInArrow(tidy(run), schema).distinct()


def near_duplicates(docs: DataFrame, text: str = "text", tile: int = TILE) -> DataFrame:
    """doc_id, fingerprint, component_id for every row of ``docs``.

    Words are runs other than [\\x20\\x09-\\x0D], A-Z lower-cased; shingles are
    runs of four words, repeats included; fewer words are one shingle; a text
    without words (a null one too) has fingerprint zero and is linked like any
    other. Fingerprints link at four or fewer differing bits. component_id is
    the smallest doc_id reachable, itself included; null only where a whole
    component has no doc_id. Equal texts are one fingerprint: copies are never
    compared with each other.
    """
    marked = Stage(fingerprints(docs, ["doc_id"], text), "fingerprints").df
    distinct = Stage(marked.groupBy("bits").agg(F.min("doc_id").alias("first")), "distinct").df
    grouped = components(links(distinct, tile))
    owned = (distinct.join(grouped.withColumnRenamed("node", "bits"), "bits", "left")
             .withColumn("component", F.coalesce("component", "bits")))
    smallest = owned.groupBy("component").agg(F.min("first").alias("component_id"))
    by_bits = Stage(owned.join(smallest, "component").select("bits", "component_id"), "components").df
    return marked.join(by_bits, "bits").select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that with the smallest doc_id.

    A row without a doc_id stays only where no row of its group has one; of
    several such rows, and of rows with the same doc_id, one stays.
    """
    stand_in = F.lit(1 << 62) + F.pmod(F.xxhash64(text), F.lit(1 << 61))
    keyed = docs.withColumn("near key", F.coalesce(F.col("doc_id").cast("long"), stand_in))
    groups = near_duplicates(keyed.select(F.col("near key").alias("doc_id"), F.col(text).alias("text")))
    first = groups.where("doc_id = component_id").select(F.col("doc_id").alias("near key"))
    return keyed.join(first, "near key", "left_semi").dropDuplicates(["near key"]).select(*docs.columns)
