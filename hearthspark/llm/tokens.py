"""Ids and token counts of public tokenizers through caches of their pre-tokens.

A text made of Basic Latin, Latin-1 and Latin Extended-A characters (but for
the dotted capital I) is cut into the tokenizer's own pre-tokens here: for
those characters the classes of letters, numbers and white space are listed
below, lower-casing maps them within the range, and NFC leaves them as they
are. A pre-token met for the first time goes through the library; its ids or
length are then remembered. Any other text, and one that holds a special
string, goes through the library whole.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType
from tokenizers import Tokenizer

from hearthspark.llm.common import append, parts, task_state, texts, tidy
from hearthspark.llm.storage import Stage

# What the two tokenizers' patterns call letter, number and white space, up to U+017F.
LETTER = "A-Za-zªµºÀ-ÖØ-öø-ſ"
NUMBER = "0-9²³¹¼-¾"
SPACE = "\\t-\\r \u0085 "
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
WORD_PATTERN = re.compile(f"{CONTRACTIONS}|[{LETTER}]+|[{NUMBER}]|[^{SPACE}{LETTER}{NUMBER}]+")
# No contraction begins as a word does, so words, the most frequent by far, are tried first.
BYTE_PATTERN = re.compile(
    f" ?[{LETTER}]+|{CONTRACTIONS}| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
BEYOND = re.compile("[^\x00-įı-ſ]")

# Entries of a generation of a worker's cache.
CACHE_ENTRIES = 300_000
# New pre-tokens encoded as one text.
GROUP = 4096
# Pre-tokens of the broadcast table, and the bytes one of them may have.
FREQUENT = 32_768
FREQUENT_BYTES = 64
# Steps of the histogram of counts for each doubling.
STEPS = 16

TOKEN_LIMIT = 2048


def load(name: str) -> Tokenizer:
    # Spark's tasks are the parallel unit; the library's own threads would compete with them.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(public_tokenizers.path(name))


class PreTokens:
    """Cuts texts into pre-tokens, or says that the library has to take them whole."""

    def __init__(self, tokenizer: Tokenizer, pattern: re.Pattern[str], lower: bool) -> None:
        self.find, self.lower = pattern.findall, lower
        self.special = [added.content for added in tokenizer.get_added_tokens_decoder().values()]

    def __call__(self, text: str) -> list[str] | None:
        if not text.isascii() and BEYOND.search(text) or any(special in text for special in self.special):
            return None
        return self.find(text.lower() if self.lower else text)


class Remembered:
    """Values of pre-tokens: a fixed first table, and a cache of two generations for the rest.

    When the young generation is full it becomes the old one, and what is still
    used moves back from there; so memory is bounded and common words stay.
    """

    def __init__(self, compute: Callable[[list[str]], list], first: dict | None = None) -> None:
        self.compute, self.first, self.old = compute, first or {}, {}
        self.known: dict = dict(self.first)

    def turn(self) -> None:
        if len(self.known) > CACHE_ENTRIES + len(self.first):
            self.old, self.known = self.known, dict(self.first)

    def add(self, new: set[str]) -> None:
        """Know these pre-tokens, none of which is known."""
        recalled = {token: self.old[token] for token in new if token in self.old}
        self.known.update(recalled)
        rest = list(new - recalled.keys())
        self.known.update(zip(rest, self.compute(rest), strict=True))

    def learn(self, cut: Sequence[list[str] | None]) -> Callable[[str], object]:
        """Know all pre-tokens of these texts; returns the lookup."""
        self.turn()
        self.add(set(chain.from_iterable(tokens for tokens in cut if tokens)) - self.known.keys())
        return self.known.__getitem__

    def values(self, cut: Sequence[list[str] | None]) -> list[list]:
        """The values of all pre-tokens of these texts in their order. Most are found at the first look."""
        self.turn()
        found = [list(map(self.known.get, tokens or ())) for tokens in cut]
        gaps = [[i for i, value in enumerate(values) if value is None] for values in found]
        self.add({tokens[i] for tokens, places in zip(cut, gaps, strict=True) for i in places})
        for tokens, values, places in zip(cut, found, gaps, strict=True):
            for i in places:
                values[i] = self.known[tokens[i]]
        return found


def grouped(found: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Places and values of pre-tokens, in groups that may be encoded as one text with separators between them."""
    bare = [token.removeprefix(" ") for token in found]
    plain = [i for i, token in enumerate(bare) if token.split() == [token]]
    for start in range(0, len(plain), GROUP):
        places = plain[start:start + GROUP]
        yield places, [found[i] for i in places]


def id_bytes(ids: Sequence[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    return np.asarray(ids, dtype="<u4").tobytes()


def encoder(name: str) -> Callable[[list[str]], list[bytes]]:
    """Ids (as bytes) of whole texts under a byte-level tokenizer."""
    tokenizer = load(name)
    cut_text = PreTokens(tokenizer, BYTE_PATTERN, lower=False)
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    # A character of a byte-level entry stands for a byte.
    sizes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
    sizes[list(vocabulary.values())] = [len(entry) for entry in vocabulary]

    def encode(found: list[str]) -> list[bytes]:
        return [id_bytes(x.ids) for x in tokenizer.encode_batch_fast(found, add_special_tokens=False)]

    def encode_new(found: list[str]) -> list[bytes]:
        # Behind one another, pre-tokens that begin with a blank are cut again where they were: the bytes of the ids say
        # where one ends.
        made: dict[str, bytes] = {}
        blank = [token for token in found if token[0] == " " and not token[-1].isspace()]
        for start in range(0, len(blank), GROUP):
            group = blank[start:start + GROUP]
            ids = np.array(encode_ids(tokenizer, "".join(group)), dtype="<u4")
            ends = np.cumsum([len(token) if token.isascii() else len(token.encode()) for token in group])
            reached = np.cumsum(sizes[ids])
            stops = np.searchsorted(reached, ends) + 1
            if reached[-1] == ends[-1] and np.array_equal(reached[stops - 1], ends):
                data, at = ids.tobytes(), [0, *(4 * stops).tolist()]
                made.update(zip(group, [data[x:y] for x, y in zip(at[:-1], at[1:], strict=True)], strict=True))
        rest = [token for token in found if token not in made]
        made.update(zip(rest, encode(rest), strict=True))
        return [made[token] for token in found]

    remembered = Remembered(encode_new)

    def run(batch: list[str]) -> list[bytes]:
        cut = [cut_text(text) for text in batch]
        return [encode([text])[0] if tokens is None else b"".join(values)
                for text, tokens, values in zip(batch, cut, remembered.values(cut), strict=True)]

    return run


def encode_ids(tokenizer: Tokenizer, text: str) -> list[int]:
    return tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids


def frequent_pre_tokens(docs: DataFrame, text: str, name: str, most: int = FREQUENT) -> list[str]:
    """The most frequent pre-tokens of at most FREQUENT_BYTES over all texts, found without a shuffle of pre-tokens.

    Each task counts its pre-tokens in a table that is cut back to the
    ``most`` commonest whenever it holds four times as many, and gives at most
    ``most`` (pre-token, count) rows. Only these bounded summaries are added up
    across tasks, and a histogram of their counts gives the count from which on
    there are ``most`` pre-tokens at most: no more than those reach the driver.
    A pre-token missed here costs time, never correctness.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut_text = PreTokens(load(name), WORD_PATTERN, lower=True)
        counts: Counter[str] = Counter()
        for batch in batches:
            for part in parts(batch, 0):
                for data in texts(part.column(0)):
                    counts.update(token for token in cut_text(data.decode()) or ()
                                  if len(token) <= FREQUENT_BYTES and len(token.encode()) <= FREQUENT_BYTES)
                if len(counts) > 4 * most:
                    counts = Counter(dict(counts.most_common(most)))
        kept = counts.most_common(most)
        yield pa.RecordBatch.from_arrays(
            [pa.array([token for token, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())],
            names=["token", "n"])

    schema = StructType([StructField("token", StringType()), StructField("n", LongType())])
    summaries = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(tidy(run), schema)
    counted = Stage(summaries.groupBy("token").agg(F.sum("n").alias("n"))
                    .withColumn("step", F.floor(F.log2("n") * STEPS).cast("int")), "pre-tokens")
    least, total = None, 0
    for row in sorted(counted.df.groupBy("step").agg(F.count("*").alias("n")).collect(), key=lambda row: -row["step"]):
        total += row["n"]
        if total > most:
            break
        least = row["step"]
    top = [] if least is None else [row["token"] for row in counted.df.where(F.col("step") >= least).collect()]
    counted.delete()
    return sorted(top)


def lengths(tokenizer: Tokenizer, found: list[str]) -> list[int]:
    return [len(x.ids) for x in tokenizer.encode_batch_fast(found, add_special_tokens=False)]


def new_lengths(tokenizer: Tokenizer) -> Callable[[list[str]], list[int]]:
    """Lengths of new pre-tokens under a tokenizer whose last token of a word carries a mark."""
    mark = json.loads(tokenizer.to_str())["model"]["end_of_word_suffix"]
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
    last[[i for token, i in vocabulary.items() if token.endswith(mark)]] = True

    def run(found: list[str]) -> list[int]:
        made = [0] * len(found)
        for places, values in grouped(found):
            ends = np.flatnonzero(last[np.array(encode_ids(tokenizer, " ".join(values)), dtype=np.int64)])
            if len(ends) == len(places):
                for place, n in zip(places, np.diff(ends, prepend=-1).tolist(), strict=True):
                    made[place] = n
        rest = [i for i, n in enumerate(made) if not n]
        for i, n in zip(rest, lengths(tokenizer, [found[i] for i in rest]), strict=True):
            made[i] = n
        return made

    return run


def count_tokens(docs: DataFrame, name: str = "word_bpe_49k.json", limit: int = TOKEN_LIMIT, frequent: int = FREQUENT,
                 keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep``, and for every text: n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    Two tiers on the map side: a broadcast table holds the lengths of at most
    ``frequent`` common pre-tokens (short ones, so about 2 MB at most), and each
    worker encodes what it lacks through a bounded cache. No pre-token is shuffled. A
    null or empty text has no bytes and no tokens; a text of any length is
    counted whole.
    """
    tokens = frequent_pre_tokens(docs, text, name, frequent)
    common = docs.sparkSession.sparkContext.broadcast(
        ("\n".join(tokens), np.array(lengths(load(name), tokens), dtype=np.uint32).tobytes()))

    def state() -> tuple[Tokenizer, PreTokens, Remembered]:
        tokenizer = load(name)
        names, sizes = common.value
        first = dict(zip(names.split("\n"), np.frombuffer(sizes, np.uint32).tolist(), strict=True)) if sizes else {}
        return tokenizer, PreTokens(tokenizer, WORD_PATTERN, lower=True), Remembered(new_lengths(tokenizer), first)

    key = "lengths", name, uuid.uuid4().hex

    def make() -> Callable[[pa.Array], Sequence[pa.Array]]:
        tokenizer, cut_text, remembered = task_state(key, state)

        def compute(column: pa.Array) -> Sequence[pa.Array]:
            data = texts(column)
            batch = [x.decode() for x in data]
            cut = [cut_text(x) for x in batch]
            get = remembered.learn(cut)
            counts = [lengths(tokenizer, [x])[0] if tokens is None else sum(map(get, tokens))
                      for x, tokens in zip(batch, cut, strict=True)]
            return (pa.array([len(x) for x in data], pa.int64()), pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()))

        return compute

    fields = [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()),
              StructField("over_limit", BooleanType())]
    return append(docs, make, fields, [text], keep, measure=text, state=key)
