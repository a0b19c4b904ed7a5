"""Benchmark decontamination with a distributed positional inverted index of the training words."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType,
)

from hearthspark.llm.common import append, ascii_words, parts, texts, tidy
from hearthspark.llm.storage import Stage

WINDOW = 13
# A document is contaminated if one of this many of its words is hit.
ONE_IN = 20

# Text of an index shard, and benchmark text that is searched for at once.
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 8 << 20
# Candidate places checked at once.
CANDIDATES = 1 << 20


def build_index(docs: DataFrame, text: str = "text", key: str = "doc_id") -> Stage:
    """Positional postings of all words of all documents, one row for each shard of about SHARD_BYTES of text.

    A shard holds its documents' keys and numbers of words, its terms, the
    number of places of each term, and the places (as differences, compressed)
    term by term. Places count through the shard's documents. Any set of test
    items can be searched for in it.
    """
    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    schema = StructType([
        StructField("shard", LongType()), StructField("keys", ArrayType(source.schema["key"].dataType)),
        StructField("sizes", ArrayType(LongType())), StructField("terms", ArrayType(BinaryType())),
        StructField("counts", ArrayType(IntegerType())), StructField("places", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for part in parts(batch, 1, SHARD_BYTES):
                words: list[bytes] = []
                sizes = []
                for data in texts(part.column(1)):
                    found = ascii_words(data)
                    sizes.append(len(found))
                    words += found
                vocabulary = {word: i for i, word in enumerate(dict.fromkeys(words))}
                ids = np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words))
                order = np.argsort(ids, kind="stable").astype(np.int32)
                counts = np.bincount(ids, minlength=len(vocabulary)).astype(np.int32)
                steps = np.diff(order, prepend=np.int32(0)).astype("<i4")
                yield pa.RecordBatch.from_arrays([
                    pa.array([number], pa.int64()), one_list(part.column(0)), one_list(pa.array(sizes, pa.int64())),
                    one_list(pa.array(list(vocabulary), pa.binary())), one_list(pa.array(counts)),
                    pa.array([squeeze(steps.tobytes())], pa.binary())], names=schema.names)
                number += 1

    return Stage(source.mapInArrow(tidy(run), schema), "index")


def one_list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


@dataclass
class Windows:
    """Test windows of one block: term numbers (padded with -1), lengths and item numbers."""

    items: list[str]
    terms: list[bytes]
    codes: np.ndarray
    lengths: np.ndarray
    owners: np.ndarray

    @classmethod
    def of(cls, rows: Sequence[tuple[str, bytes]], window: int) -> Windows:
        terms: dict[bytes, int] = {}
        items: list[str] = []
        cut: dict[tuple[int, ...], set[int]] = {}
        for item, data in rows:
            words = [terms.setdefault(word, len(terms)) for word in ascii_words(data)]
            items.append(item)
            for start in range(max(1, len(words) - window + 1) if words else 0):
                cut.setdefault(tuple(words[start:start + window]), set()).add(len(items) - 1)
        pairs = [(codes, owner) for codes, owners in cut.items() for owner in sorted(owners)]
        table = np.full((len(pairs), window), -1, dtype=np.int32)
        for i, (codes, _) in enumerate(pairs):
            table[i, :len(codes)] = codes
        return cls(items, list(terms), table, np.array([len(codes) for codes, _ in pairs], dtype=np.int64),
                   np.array([owner for _, owner in pairs], dtype=np.int64))


class Shard:
    """One index row opened for a block of test windows."""

    def __init__(self, row: dict, terms: pa.Array, windows: Windows) -> None:
        sizes = np.asarray(row["sizes"], dtype=np.int64)
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        steps = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["places"]), dtype="<i4")
        self.places = np.cumsum(steps, dtype=np.int64)
        counts = np.asarray(row["counts"], dtype=np.int64)
        firsts = np.concatenate(([0], np.cumsum(counts)))[:-1]
        own = pc.index_in(terms, value_set=row["terms"]).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        here = own >= 0
        # Of each test term: its number of places in this shard and where they begin in the postings.
        self.counts = np.where(here, counts[own] if len(counts) else 0, 0)
        self.firsts = np.where(here, firsts[own] if len(firsts) else 0, 0)
        # The offset-adjusted lists of all terms are intersected by looking places up here.
        self.term_at = np.full(len(self.places), -1, dtype=np.int32)
        for code in np.flatnonzero(here):
            self.term_at[self.postings(code)] = code
        self.windows = windows

    def postings(self, code: int) -> np.ndarray:
        return self.places[self.firsts[code]:self.firsts[code] + self.counts[code]]

    def rarest_first(self) -> tuple[np.ndarray, np.ndarray]:
        """Windows all of whose terms are here, and the order of their terms by number of places."""
        codes = self.windows.codes
        counts = np.where(codes < 0, np.iinfo(np.int64).max, self.counts[codes] if len(self.counts) else 0)
        alive = np.flatnonzero(counts.min(axis=1, initial=np.iinfo(np.int64).max) > 0)
        return alive, np.argsort(counts[alive], axis=1, kind="stable")

    def candidates(self, alive: np.ndarray, lead: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row of ``alive``, first word) for each place of the window's ``lead`` term, in bounded portions."""
        codes = self.windows.codes[alive, lead]
        counts = self.counts[codes]
        ends = np.cumsum(counts)
        start = 0
        while start < len(alive):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + CANDIDATES, side="right")))
            own = np.repeat(np.arange(start, stop), counts[start:stop])
            within = np.arange(len(own)) - np.repeat(ends[start:stop] - counts[start:stop] - base, counts[start:stop])
            yield own, self.places[self.firsts[codes[own]] + within] - lead[own]
            start = stop

    def within_document(self, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Do the words from ``first`` lie in one document?"""
        doc = np.searchsorted(self.starts, first, side="right") - 1
        end = first + length
        return (first >= 0) & (end <= self.starts[-1]) & (end <= self.starts[np.minimum(doc + 1, len(self.starts) - 1)])

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        """(window, first word) of every exact occurrence: candidates of the rarest term, then term after term."""
        alive, order = self.rarest_first()
        found: list[tuple[np.ndarray, np.ndarray]] = []
        codes, lengths = self.windows.codes, self.windows.lengths
        for own, first in self.candidates(alive, order[:, 0]) if len(alive) else ():
            fit = self.within_document(first, lengths[alive[own]])
            own, first = own[fit], first[fit]
            for rank in range(1, codes.shape[1]):
                offset = order[own, rank]
                code = codes[alive[own], offset]
                # Past a short window's end there is nothing to compare.
                fit = (code < 0) | (self.term_at[np.minimum(first + offset, len(self.term_at) - 1)] == code)
                own, first = own[fit], first[fit]
            found.append((alive[own], first))
        return joined(found)

    def near_phrases(self, slop: int, missing: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, first word) where all but ``missing`` of a window's words stand within ``slop`` of their places.

        Of any missing + 1 words one is there, so the places of the
        missing + 1 rarest terms, moved by up to ``slop``, give all candidates.
        """
        codes, lengths = self.windows.codes, self.windows.lengths
        counts = np.where(codes < 0, np.iinfo(np.int64).max, self.counts[codes] if len(self.counts) else 0)
        order = np.argsort(counts, axis=1, kind="stable")
        present = ((codes >= 0) & (counts > 0)).sum(axis=1)
        alive = np.flatnonzero((present >= lengths - missing) & (lengths > missing))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for rank in range(missing + 1):
            lead = order[alive, rank] if len(alive) else np.zeros(0, dtype=np.int64)
            some = self.counts[codes[alive, lead]] > 0 if len(alive) else np.zeros(0, dtype=bool)
            for own, middle in self.candidates(alive[some], lead[some]) if some.any() else ():
                rows = alive[some][own]
                for shift in range(-slop, slop + 1):
                    first = middle + shift
                    fit = self.within_document(first, lengths[rows])
                    inside, start = rows[fit], first[fit]
                    doc = np.searchsorted(self.starts, start, side="right") - 1
                    there = np.zeros(len(inside), dtype=np.int64)
                    for offset in range(codes.shape[1]):
                        code = codes[inside, offset]
                        hit = np.zeros(len(inside), dtype=bool)
                        for move in range(-slop, slop + 1):
                            place = start + offset + move
                            fit = (place >= self.starts[doc]) & (place < self.starts[doc + 1])
                            hit |= fit & (self.term_at[np.clip(place, 0, len(self.term_at) - 1)] == code)
                        there += hit & (code >= 0)
                    near = there >= lengths[inside] - missing
                    found.append((inside[near], start[near]))
        return joined(found)


def joined(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])


def search(index: DataFrame, rows: Sequence[tuple[str, bytes]], window: int, proximity: tuple[int, int] | None,
           everything: bool) -> DataFrame:
    """For each document of the index, or each with a match: key, n_words, spans of hit words, items, near items."""
    sent = index.sparkSession.sparkContext.broadcast(list(rows))
    key_type = index.schema["keys"].dataType.elementType
    schema = StructType([
        StructField("shard", LongType()), StructField("place", LongType()), StructField("key", key_type),
        StructField("n_words", LongType()), StructField("spans", ArrayType(SPAN)),
        StructField("items", ArrayType(StringType())), StructField("near_items", ArrayType(StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows.of(sent.value, window)
        terms = pa.array(windows.terms, pa.binary())
        names = np.array(windows.items, dtype=object)
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.slice(i, 1)
                row = {name: part.column(name)[0].as_py() for name in ("shard", "sizes", "counts", "places")}
                row["terms"] = part.column("terms").flatten()
                shard = Shard(row, terms, windows)
                found, first = shard.phrases()
                near, near_first = (found[:0], first[:0]) if proximity is None else shard.near_phrases(*proximity)
                sizes = np.asarray(row["sizes"], dtype=np.int64)
                spans = hit_spans(shard, first, windows.lengths[found])
                owners = [items_of(shard, windows.owners[w], at, names, len(sizes))
                          for w, at in ((found, first), (near, near_first))]
                shown = np.arange(len(sizes)) if everything else np.array(
                    sorted(set(spans) | set(owners[0]) | set(owners[1])), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(shown), row["shard"], dtype=np.int64)), pa.array(shown, pa.int64()),
                    part.column("keys").flatten().take(pa.array(shown, pa.int64())), pa.array(sizes[shown]),
                    pa.array([spans.get(d, []) for d in shown.tolist()],
                             pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    *[pa.array([x.get(d, []) for d in shown.tolist()], pa.list_(pa.string())) for x in owners]],
                    names=schema.names)

    return index.mapInArrow(tidy(run), schema)


def hit_spans(shard: Shard, first: np.ndarray, length: np.ndarray) -> dict[int, list[dict[str, int]]]:
    """By document, the runs of hit words, counted within the document."""
    if not len(first):
        return {}
    marks = np.zeros(len(shard.places) + 1, dtype=np.int64)
    np.add.at(marks, first, 1)
    np.add.at(marks, first + length, -1)
    edges = np.diff((np.cumsum(marks[:-1]) > 0).astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    spans: dict[int, list[dict[str, int]]] = {}
    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
        # A run over a border between documents is one for each.
        doc = int(np.searchsorted(shard.starts, start, side="right")) - 1
        while start < end:
            stop = min(end, int(shard.starts[doc + 1]))
            if start < stop:
                base = int(shard.starts[doc])
                spans.setdefault(doc, []).append({"start": start - base, "end": stop - base})
            start, doc = stop, doc + 1
    return spans


def items_of(shard: Shard, owners: np.ndarray, first: np.ndarray, names: np.ndarray, docs: int
             ) -> dict[int, list[str]]:
    """By document, its items in the order of strings."""
    doc = np.searchsorted(shard.starts, first, side="right") - 1
    found: dict[int, set[str]] = {}
    for d, owner in set(zip(doc.tolist(), owners.tolist(), strict=True)):
        found.setdefault(d, set()).add(names[owner])
    return {d: sorted(items) for d, items in found.items()}


def item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items (id as text, text) in blocks of about ``block_bytes``; items without id or text have no windows."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text")
                             ).where("item is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = 1 + size // block_bytes
    for i in range(blocks):
        rows: list[Row] = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == i).collect()
        yield sorted((row["item"], bytes(row["text"])) for row in rows)


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id",
                       window: int = WINDOW, one_in: int = ONE_IN, proximity: tuple[int, int] | None = None,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For every document: key, n_words, n_hit, n_items, items_sha256, contaminated, spans, items, near_items.

    Words are runs of ASCII letters and digits and of non-ASCII characters,
    A-Z lower-cased. Test windows are all runs of ``window`` words of an item;
    a shorter item with words is one window. A document's word inside an
    occurrence of a window is hit. items are the ids of items with an
    occurring window, in the order of strings; items_sha256 is the hash of
    them, comma-joined. contaminated: some word is hit, and at least one in
    ``one_in``. With ``proximity`` = (slop, missing), near_items also lists
    items of which some window stands in the document with all but ``missing``
    of its words, each within ``slop`` words of its place.

    Items come in blocks of ``block_bytes`` (a stated bound of what is
    broadcast); a larger benchmark takes more passes over the index. A null
    text has no words and no windows. Items without an id are left out; rows
    with the same item_id are one item. Every row of ``docs`` is a document.
    """
    index = build_index(docs, text, key).df
    # The first block's pass gives all documents, the others those with a match.
    passes = [search(index, rows, window, proximity, everything=i == 0)
              for i, rows in enumerate(item_blocks(benchmark, block_bytes))]
    found = reduce(DataFrame.unionByName, passes)
    if len(passes) > 1:
        found = found.groupBy("shard", "place").agg(
            F.first("key").alias("key"), F.first("n_words").alias("n_words"),
            *[F.flatten(F.collect_list(name)).alias(name) for name in ("spans", "items", "near_items")])

    def make() -> Callable[..., Sequence[pa.Array]]:
        def compute(n_words: pa.Array, spans: pa.Array, items: pa.Array) -> Sequence[pa.Array]:
            hits = [covered(x) for x in spans.to_pylist()]
            ids = [sorted(set(x)) for x in items.to_pylist()]
            words = n_words.to_pylist()
            return (pa.array(hits, pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in ids], pa.string()),
                    pa.array([hit > 0 and one_in * hit >= n for hit, n in zip(hits, words, strict=True)], pa.bool_()))

        return compute

    fields = [StructField("n_hit", LongType()), StructField("n_items", LongType()),
              StructField("items_sha256", StringType()), StructField("contaminated", BooleanType())]
    full = append(found, make, fields, ["n_words", "spans", "items"],
                  ["key", "n_words", "spans", "items", "near_items"])
    return full.select(F.col("key").alias(key), "n_words", *[field.name for field in fields], "spans",
                       F.array_sort(F.array_distinct("items")).alias("items"),
                       F.array_sort(F.array_distinct("near_items")).alias("near_items"))


def covered(spans: Sequence[dict[str, int]]) -> int:
    """Words in the union of spans."""
    total = reached = 0
    for span in sorted(spans, key=lambda x: x["start"]):
        start = max(span["start"], reached)
        total += max(0, span["end"] - start)
        reached = max(reached, span["end"])
    return total


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that aren't contaminated. What is decided of a text holds for all rows with it."""
    digest = F.xxhash64(F.coalesce(F.col(text), F.lit(""))), F.xxhash64(F.lit(1), F.coalesce(F.col(text), F.lit("")))
    keyed = docs.withColumn("text key", F.struct(*[x.alias(name) for x, name in zip(digest, ("a", "b"), strict=True)]))
    found = find_contamination(keyed, benchmark, text, key="text key")
    bad = found.where("contaminated").select("text key").distinct()
    return keyed.join(bad, "text key", "left_anti").select(*docs.columns)
