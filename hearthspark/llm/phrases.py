"""Phrase collocations by the SON scheme: mine each shard at a lowered support, then count what any shard proposed."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from hearthspark.llm.common import parts, texts, tidy
from hearthspark.llm.storage import Stage

SUPPORT = 10
LONGEST = 3
SHARE = 50
TOP = 2000
NO_LANGUAGE = "und"

# Text of a shard.
SHARD_BYTES = 8 << 20
# Rows handed over at once: what a shard proposes is cut into batches.
BATCH_ROWS = 50_000
# Languages whose sizes the shards know; in any other the local support is 1, at which mining is complete as well.
LANGUAGES = 10_000
# Bits of a filter for each key in it, at most in all, and those a key sets. Beyond that size more phrases pass and are
# counted for nothing; none is lost.
BITS_EACH, MOST_BITS, PROBES = 16, 1 << 27, 3
# Parts of a language that are ranked on their own before the last ranking.
SALTS = 64

# A-Z to a-z, the white space within a piece to a blank, the ends of pieces to a line feed.
TABLE = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 9 else 10 if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))
# What stands for the end of a piece among words; no UTF-8 text has that byte.
BORDER = b"\xff"

Rows = Iterator[pa.RecordBatch]


# ---- keys and filters of bounded size ---------------------------------------------------

def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread over all places, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Key of a phrase with one more word, from the phrase's key and the word's."""
    return mixed(key * np.uint64(3) + mixed(word))


class KeyFilter:
    """A Bloom filter: says no only to keys that are not in it."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words

    @staticmethod
    def places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
        """Bit places of keys: a step of odd width from a first place."""
        step = (keys >> np.uint64(32)) | np.uint64(1)
        return [(keys + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(PROBES)]

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for place in self.places(keys, 64 * len(self.words)):
            found &= (self.words[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found

    @staticmethod
    def of(keys: DataFrame, n: int) -> KeyFilter:
        """Filter of the ``n`` values of the column ``key``, put together from the words of each task.

        At most MOST_BITS bits, 16 MB, reach the driver.
        """
        bits = min(MOST_BITS, 1 << max(10, (BITS_EACH * n).bit_length()))

        def set_bits(batches: Rows) -> Rows:
            for batch in batches:
                own = batch.column(0).to_numpy().view(np.uint64)
                places = np.unique(np.concatenate(KeyFilter.places(own, bits)))
                word = (places >> np.uint64(6)).astype(np.int64)
                first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, np.int64)
                value = np.uint64(1) << (places & np.uint64(63))
                made = np.bitwise_or.reduceat(value, first) if len(first) else value
                yield pa.RecordBatch.from_arrays([pa.array(word[first]), pa.array(made.view(np.int64))],
                                                 names=["word", "value"])

        words = np.zeros(bits // 64, np.uint64)
        found = (keys.select("key").mapInArrow(tidy(set_bits), "word long, value long").groupBy("word")
                 .agg(F.bit_or("value").alias("value")).toArrow())
        words[found.column("word").to_numpy()] = found.column("value").to_numpy().view(np.uint64)
        return KeyFilter(words)


# ---- shards -----------------------------------------------------------------------------

@dataclass
class Phrases:
    """Phrases of one length in a shard: where each occurrence begins and which of the distinct ones it is, and the
    keys, words and counts of those."""

    at: np.ndarray
    number: np.ndarray
    keys: np.ndarray
    words: np.ndarray
    times: np.ndarray


@dataclass
class Shard:
    """Words of one language in a run of documents, as numbers; 0 is the end of a piece."""

    language: str
    codes: np.ndarray
    words: list[bytes]
    own_keys: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        seed = xxhash.xxh64_intdigest(self.language.encode())
        self.own_keys = np.array([xxhash.xxh64_intdigest(word, seed) for word in self.words], np.uint64)

    def counts(self) -> np.ndarray:
        found = np.bincount(self.codes, minlength=len(self.words))
        found[0] = 0
        return found

    def phrases(self, length: int, filters: list[KeyFilter]) -> Phrases:
        """All phrases of so many words whose first and last parts pass the filter of their length, one shorter.

        ``filters[i]`` knows the phrases of i + 1 words that are frequent over
        all documents: a phrase with a rarer part can't be frequent.
        """
        at = np.flatnonzero(self.codes)
        found = Phrases(at, self.codes[at], self.own_keys, np.arange(len(self.words))[:, None], self.counts())
        for size in range(1, length):
            passing = filters[size - 1].has(found.keys)
            on = passing[found.number]
            at, number = found.at[on], found.number[on]
            # The same phrases again, seen as the last part of one that begins a word earlier.
            follows = np.flatnonzero(at[1:] == at[:-1] + 1) if len(at) else np.zeros(0, np.int64)
            first, last = number[follows], number[follows + 1]
            word = found.words[last, -1].astype(np.int64)
            packed, inverse, times = np.unique(first.astype(np.int64) * len(self.words) + word, return_inverse=True,
                                               return_counts=True)
            head, tail = np.divmod(packed, len(self.words))
            words = np.column_stack((found.words[head], tail))
            found = Phrases(at[follows], inverse, joined(found.keys[head], self.own_keys[tail]), words, times)
        return found

    def text(self, words: np.ndarray) -> list[bytes]:
        return [b" ".join([self.words[i] for i in row]) for row in words.tolist()]


def read_shards(batches: Rows) -> Iterator[Shard]:
    """The shards of a task: runs of its rows of bounded bytes, one shard for each language in them."""
    held: dict[str, list[bytes]] = defaultdict(list)
    size = 0

    def cut() -> Iterator[Shard]:
        for language, bodies in held.items():
            numbers: dict[bytes, int] = defaultdict(lambda: len(numbers))
            numbers[BORDER]
            # Only blanks are white space to ``split`` by now.
            codes = [np.fromiter(map(numbers.__getitem__, body.replace(b"\n", b" \xff ").split()), np.int64)
                     for body in bodies]
            yield Shard(language, np.concatenate(codes), list(numbers))

    for batch in batches:
        for part in parts(batch, 1):
            for language, text in zip(part.column(0).to_pylist(), texts(part.column(1)), strict=True):
                # A line feed at the end of each text: no phrase runs into the next.
                held[language].append(text.translate(TABLE) + b"\n")
                size += len(text)
            if size >= SHARD_BYTES:
                yield from cut()
                held.clear()
                size = 0
    yield from cut()


def over_shards(docs: DataFrame, work: Callable[[Shard], dict[str, pa.Array]], schema: StructType) -> DataFrame:
    """Rows that ``work`` makes of each shard."""

    def run(batches: Rows) -> Rows:
        for shard in read_shards(batches):
            made = work(shard)
            whole = pa.RecordBatch.from_arrays([made[name] for name in schema.names], names=schema.names)
            for start in range(0, whole.num_rows, BATCH_ROWS):
                yield whole.slice(start, BATCH_ROWS)

    return docs.mapInArrow(tidy(run), schema)


def constant(value: str, n: int) -> pa.Array:
    return pa.array([value], pa.string()).take(pa.array(np.zeros(n, np.int32)))


def text_array(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


LONG = LongType()
COUNTED = StructType([StructField("lang", StringType()), StructField("phrase", StringType()), StructField("key", LONG),
                      StructField("n", LONG)])
MINED = StructType([StructField("key", LONG), StructField("n", LONG), StructField("spare", LONG)])


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, phrase, key, n) of all words; without a phrase, n shards of ``key`` words of the language."""

    def work(shard: Shard) -> dict[str, pa.Array]:
        n = shard.counts()
        found = np.flatnonzero(n)
        keys = np.r_[shard.own_keys[found].view(np.int64), n.sum()]
        return {"lang": constant(shard.language, len(keys)), "phrase": text_array([*[shard.words[i] for i in found], None]),
                "key": pa.array(keys), "n": pa.array(np.r_[n[found], 1])}

    return over_shards(docs, work, COUNTED).groupBy("lang", "phrase", "key").agg(F.sum("n").alias("n"))


def local_support(support: int, n: int, total: int | None) -> int:
    """The count that a phrase with that support over ``total`` words has in one shard at least, when each shard has a
    part of the support by its ``n`` words."""
    return 1 if total is None else max(1, -(-support * n // total))


def candidates(docs: DataFrame, length: int, support: int, totals: Broadcast[dict[str, int]], spare: int,
               filters: list[Broadcast[KeyFilter]]) -> DataFrame:
    """Keys of the phrases that are frequent in some shard and may be frequent in all.

    A shard that doesn't name a phrase has fewer of it than its local support.
    So a phrase has at most the sum of what was named and of what the other
    shards, ``spare`` in all less those that named it, may have kept to
    themselves.
    """

    def mine(shard: Shard) -> dict[str, pa.Array]:
        least = local_support(support, int(shard.counts().sum()), totals.value.get(shard.language))
        found = shard.phrases(length, [x.value for x in filters])
        local = np.flatnonzero(found.times >= least)
        return {"key": pa.array(found.keys[local].view(np.int64)), "n": pa.array(found.times[local]),
                "spare": pa.array(np.full(len(local), least - 1))}

    named = over_shards(docs, mine, MINED).groupBy("key").agg(F.sum("n").alias("n"), F.sum("spare").alias("spare"))
    return named.where(F.col("n") + F.lit(spare) - F.col("spare") >= support).select("key")


def count_phrases(docs: DataFrame, length: int, filters: list[Broadcast[KeyFilter]], among: Broadcast[KeyFilter]
                  ) -> DataFrame:
    """(lang, phrase, key, n) of phrases of so many words, counted over all shards by their text: those whose key is
    in ``among`` with all their occurrences."""

    def work(shard: Shard) -> dict[str, pa.Array]:
        found = shard.phrases(length, [x.value for x in filters])
        asked = np.flatnonzero(among.value.has(found.keys))
        return {"lang": constant(shard.language, len(asked)), "phrase": text_array(shard.text(found.words[asked])),
                "key": pa.array(found.keys[asked].view(np.int64)), "n": pa.array(found.times[asked])}

    return over_shards(docs, work, COUNTED).groupBy("lang", "phrase", "key").agg(F.sum("n").alias("n"))


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST
                     ) -> tuple[dict[int, DataFrame], DataFrame]:
    """For each length 1 to ``longest`` the (lang, phrase, key, n) with n >= ``support``, and (lang, n) of all words.

    ``docs`` has the columns lang and text, and gives the same partitions each
    time it is read, as a table does.
    """
    spark = docs.sparkSession
    words = Stage(word_counts(docs), "words").df
    shards = words.where(F.col("phrase").isNull())
    sizes = Stage(shards.groupBy("lang").agg(F.sum(F.col("key") * F.col("n")).alias("n")), "sizes").df
    known = sizes.where("n > 0").orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    totals = {row["lang"]: row["n"] for row in known.collect()}
    kept = F.ceil(F.lit(support).cast("decimal(18,0)") * F.col("key") / F.col("total")) - 1
    spare = (shards.where("key > 0").join(known.withColumnRenamed("n", "total"), "lang").groupBy("lang")
             .agg(F.sum(F.col("n") * kept).alias("spare")).agg(F.max("spare")).first()[0] or 0)
    shared_totals = spark.sparkContext.broadcast(totals)
    found = {1: words.where(F.col("phrase").isNotNull() & (F.col("n") >= support))}
    filters: list[Broadcast[KeyFilter]] = []
    for length in range(2, longest + 1):
        filters.append(shared_filter(spark, found[length - 1]))
        proposed = Stage(candidates(docs, length, support, shared_totals, int(spare), filters), "candidates")
        among = shared_filter(spark, proposed.df)
        counted = count_phrases(docs, length, filters, among).where(F.col("n") >= support)
        found[length] = Stage(counted, "phrases").df
        proposed.delete()
        among.unpersist()
    return found, sizes


def shared_filter(spark: SparkSession, keys: DataFrame) -> Broadcast[KeyFilter]:
    return spark.sparkContext.broadcast(KeyFilter.of(keys, keys.count()))


# ---- scores -----------------------------------------------------------------------------

def exact(name: str) -> Column:
    """A count as a whole decimal."""
    return F.col(name).cast("decimal(18,0)")


def floored_score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (l * r)) by whole division of decimals; no product loses a digit below 10**16."""
    million = F.lit(1_000_000).cast("decimal(7,0)")
    top = (exact(a) * exact(a)).cast("decimal(31,0)") * million
    return F.call_function("div", top.cast("decimal(38,0)"), (exact(left) * exact(right)).cast("decimal(38,0)"))


def scored(found: dict[int, DataFrame], length: int) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates of one length, cut where the score is least."""
    rows = found[length].select("lang", "phrase", F.col("n").alias("a"))
    cuts = []
    for k in range(1, length):
        first = found[k].select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
        rest = found[length - k].select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
        rows = (rows.withColumn("first", F.substring_index("phrase", " ", k))
                .withColumn("rest", F.substring_index("phrase", " ", k - length))
                .join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).drop("first", "rest"))
        rows = rows.withColumn(f"cut {k}", F.struct(floored_score("a", "l", "r").alias("score"), F.lit(k).alias("k"),
                                                    "l", "r")).drop("l", "r")
        cuts.append(f"cut {k}")
    best = F.array_min(F.array(*[F.col(f"`{name}`") for name in cuts])).alias("best")
    return rows.select("lang", "phrase", "a", best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def inner_phrases(found: dict[int, DataFrame], length: int, longest: int) -> DataFrame:
    """(lang, phrase, most): the largest count of a longer candidate that holds the phrase."""
    held = []
    for longer in range(length + 1, longest + 1):
        words = F.split("phrase", " ")
        held.append(found[longer].select("lang", "n", F.explode(F.array(*[
            F.array_join(F.slice(words, start + 1, length), " ") for start in range(longer - length + 1)]))
            .alias("phrase")))
    return reduce(DataFrame.unionByName, held).groupBy("lang", "phrase").agg(F.max("n").alias("most"))


def collocations(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, share: int = SHARE, top: int = TOP,
                 text: str = "text", lang: str = "lang") -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    A-Z are lower-cased, texts split at [.,;:!?\\x0A-\\x0D] into pieces and those
    into words [^\\x20\\x09]+. Candidates are phrases of 2 to ``longest`` words of a piece
    with a >= ``support`` occurrences, overlaps included, counted by the SON
    scheme: shards of bounded bytes are mined completely at a local support in
    proportion to their words of the language, the union of what they name is
    counted over all shards. Score is floor(1000000 * a * a / (l * r)) with the
    counts of both parts at the cut with the least score (the first of them);
    a candidate inside a longer one with ``share`` percent of its count or more
    is left out. n counts the words of the language. A null text is empty, a
    null language ``und``; every row of ``docs`` is a text of its own. A
    language without candidates has no rows.
    """
    source = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(f"`{text}`").alias("text"))
    found, sizes = frequent_phrases(source, support, longest)
    kept = []
    for length in range(2, longest + 1):
        rows = scored(found, length)
        if length < longest:
            inner = inner_phrases(found, length, longest)
            rows = (rows.join(inner, ["lang", "phrase"], "left")
                    .where(F.coalesce(100 * F.col("most") < share * F.col("a"), F.lit(True))).drop("most"))
        kept.append(rows)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language is ranked in parts first, so that only ``top`` rows of each part meet in one task.
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    ranked = reduce(DataFrame.unionByName, kept).withColumn("part", part)
    first = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    last = first.where(F.col("rank") <= top).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return (last.where(F.col("rank") <= top).join(sizes, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                    F.col("score").cast("long").alias("score")))
