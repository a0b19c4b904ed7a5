"""Aligning the tokens of two tokenizers: divide and conquer at the byte offsets where tokens of both end."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from hearthspark.llm import pieces, tokens
from hearthspark.llm.common import parts, task_state, texts, tidy
from hearthspark.llm.storage import Stage
from hearthspark.llm.units import MARK, DistinctTable, ends_visibly, units

TOKENIZER = "byte_bpe_50k.json"
# Text of a block of documents that share a list of id pairs, and the rows it has at most.
BLOCK_BYTES = 16 << 20
BLOCK_ROWS = 50_000
# Parts of a text aligned at once: a longer text is cut at one of its shared cuts first.
RUN_UNITS = 100_000
# Parts encoded in one call of a library.
GROUP = 4096
# Links of a group up to which they are listed one by one; beyond, equal ids are counted first.
SMALL_GROUP = 64
# A link is a number of 32 bits: id of A * WIDTH + id of B.
WIDTH = 1 << 16

COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


# ---- tokens and their bytes -----------------------------------------------------------

def byte_values() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: visible Latin-1 characters for themselves,
    then the others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level_entries(tokenizer: Tokenizer) -> list[bytes]:
    """Bytes of each id. An added token, which no text is encoded to, stands for its own characters."""
    value = byte_values()
    found = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for entry, i in tokenizer.get_vocab(with_added_tokens=True).items():
        plain = all(c in value for c in entry)
        found[i] = bytes(value[c] for c in entry) if plain else entry.encode()
    return found


def piece_entries(model: SentencePieceProcessor) -> list[bytes]:
    """Bytes of each id: a byte piece is its byte, a mark is a blank."""
    listed = [(model.id_to_piece(i), model.is_byte(i)) for i in range(model.vocab_size())]
    return [bytes([int(piece[3:5], 16)]) if is_byte else piece.replace(MARK, " ").encode() for piece, is_byte in listed]


class Pair:
    """Both tokenizers: ids of parts of texts as ``units`` cuts them."""

    def __init__(self, first: str, second: str) -> None:
        self.a, self.b = tokens.load(first), pieces.load(second)
        self.a.encode_special_tokens = True
        self.bytes_a, self.bytes_b = byte_level_entries(self.a), piece_entries(self.b)
        self.sizes_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.sizes_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        self.names_a, self.names_b = (pa.array([str(i) for i in range(len(x))]) for x in (self.sizes_a, self.sizes_b))
        self.binary_a, self.binary_b = pa.array(self.bytes_a, pa.binary()), pa.array(self.bytes_b, pa.binary())
        if len(self.bytes_a) >= 1 << 16 or len(self.bytes_b) > WIDTH:
            raise ValueError("a link of these vocabularies takes more than 32 bits")
        self.lone = [self.b.piece_to_id(MARK)]
        self.table = DistinctTable(self.encode)

    def ids_a(self, text: str) -> list[int]:
        return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def ids_b(self, text: str) -> list[int]:
        """Ids of a text that begins with a blank, which the library puts there itself."""
        return self.lone if text == " " else self.b.encode(text[1:])

    def whole(self, unit: str) -> tuple[bytes, bytes] | None:
        """Ids of one part as 32-bit numbers, none if the bytes of its tokens are not its own."""
        a, b, own = self.ids_a(unit), self.ids_b(unit), unit.encode()
        if b"".join([self.bytes_a[i] for i in a]) != own or b"".join([self.bytes_b[i] for i in b]) != own:
            return None
        return np.array(a, np.int32).tobytes(), np.array(b, np.int32).tobytes()

    def encode(self, found: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of parts. Those that end in a visible character are encoded many at a time as one text."""
        made: list[tuple[bytes, bytes] | None] = [None] * len(found)
        joined = [i for i, unit in enumerate(found) if len(unit) < GROUP and MARK not in unit and ends_visibly(unit)]
        single = set(range(len(found))).difference(joined)
        for start in range(0, len(joined), GROUP):
            places = joined[start:start + GROUP]
            text = "".join([found[i] for i in places])
            ends = np.cumsum([len(found[i].encode()) for i in places])
            cut_a = cut_ids(self.ids_a(text), self.binary_a, self.sizes_a, text.encode(), ends)
            cut_b = cut_ids(self.ids_b(text), self.binary_b, self.sizes_b, text.encode(), ends)
            if cut_a is not None and cut_b is not None:
                for place, ids_a, ids_b in zip(places, cut_a, cut_b, strict=True):
                    made[place] = ids_a, ids_b
            else:
                single.update(places)
        for i in single:
            made[i] = self.whole(found[i])
        return made


def cut_ids(ids: list[int], entries: pa.Array, sizes: np.ndarray, text: bytes, ends: np.ndarray) -> list[bytes] | None:
    """``ids`` cut where their bytes reach ``ends``; none if they aren't those of ``text`` or one crosses an end."""
    numbers = np.array(ids, dtype=np.int32)
    reached = np.cumsum(sizes[numbers])
    if reached[-1] != len(text) or entries.take(pa.array(numbers)).buffers()[2].to_pybytes()[:len(text)] != text:
        return None
    stops = np.searchsorted(reached, ends) + 1
    if not np.array_equal(reached[stops - 1], ends):
        return None
    data, at = numbers.tobytes(), [0, *(4 * stops).tolist()]
    return [data[x:y] for x, y in zip(at[:-1], at[1:], strict=True)]


# ---- divide and conquer -----------------------------------------------------------------

def near_middle(a: np.ndarray, b: np.ndarray, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray]:
    """For each interval, places in a[a0:a1] and b[b0:b1] of a common end: the first from the middle of ``a`` on, else
    the last before it, -1 where there is none.

    From the middle each side is bisected for what the other one offers next,
    in all intervals at once, until both stand at the same end or one side is
    used up.
    """
    i = (a0 + a1) // 2
    place_a, place_b = np.full(len(i), -1), np.full(len(i), -1)
    j = np.searchsorted(b, a[i])
    before = i, j
    left = np.arange(len(i))
    while len(left):
        same = a[i] == b[j]
        place_a[left[same]], place_b[left[same]] = i[same], j[same]
        # The last ends of an interval are one offset, so neither search leaves it.
        i = np.searchsorted(a, b[j])
        ahead = a[i] != b[j]
        j = np.where(ahead, np.searchsorted(b, a[i]), j)
        on = ~same & (i < a1[left]) & (j < b1[left])
        left, i, j = left[on], i[on], j[on]
    left = np.flatnonzero(place_a < 0)
    i, j = before[0][left] - 1, before[1][left] - 1
    on = (i >= a0[left]) & (j >= b0[left])
    left, i, j = left[on], i[on], j[on]
    while len(left):
        same = a[i] == b[j]
        place_a[left[same]], place_b[left[same]] = i[same], j[same]
        lower = np.minimum(a[i], b[j])
        i, j = np.searchsorted(a, lower, side="right") - 1, np.searchsorted(b, lower, side="right") - 1
        on = ~same & (i >= a0[left]) & (j >= b0[left])
        left, i, j = left[on], i[on], j[on]
    return place_a, place_b


def shared_groups(a: np.ndarray, b: np.ndarray, stops_a: np.ndarray, stops_b: np.ndarray
                  ) -> tuple[np.ndarray, np.ndarray]:
    """Where groups end in two ascending lists of token ends: places behind their last tokens, ascending.

    ``stops_a`` and ``stops_b`` are the places behind the last tokens of texts
    that stand one behind the other; each text is an interval at first. An
    interval is cut at a common end near its middle and both halves go on; one
    without a common end inside is a group. All intervals of a depth are cut
    at the same time.
    """
    a0, b0 = np.r_[0, stops_a[:-1]], np.r_[0, stops_b[:-1]]
    a1, b1 = stops_a - 1, stops_b - 1
    done_a, done_b = [], []
    while len(a0):
        # A cut inside needs a token besides the last one on both sides.
        wide = np.flatnonzero((a0 < a1) & (b0 < b1))
        i, j = np.full(len(a0), -1), np.full(len(a0), -1)
        i[wide], j[wide] = near_middle(a, b, a0[wide], a1[wide], b0[wide], b1[wide])
        cut = i >= 0
        done_a.append(a1[~cut] + 1)
        done_b.append(b1[~cut] + 1)
        a0, a1, b0, b1, i, j = (x[cut] for x in (a0, a1, b0, b1, i, j))
        a0, a1, b0, b1 = (np.column_stack(x).ravel() for x in ((a0, i + 1), (i, a1), (b0, j + 1), (j, b1)))
    found_a, found_b = np.concatenate([*done_a, np.zeros(0, np.int64)]), np.concatenate([*done_b, np.zeros(0, np.int64)])
    # Every group ends at an offset of its own on both sides.
    return np.sort(found_a), np.sort(found_b)


def group_texts(names: pa.Array, ids: np.ndarray, stops: np.ndarray) -> pa.Array:
    """Ids of each group in decimal, joined by commas."""
    offsets = pa.array(np.r_[0, stops].astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, names.take(pa.array(ids))), ",")


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their weights."""
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(weights, first) if len(first) else weights


def link_counts(a: np.ndarray, b: np.ndarray, stops_a: np.ndarray, stops_b: np.ndarray, owner: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray]:
    """Distinct links of each owner of groups as owner << 32 | a * WIDTH + b, and how many token pairs each links.

    The pairs of a large group are not listed: equal ids are counted on both sides first.
    """
    starts_a, starts_b = np.r_[0, stops_a[:-1]], np.r_[0, stops_b[:-1]]
    n_a, n_b = stops_a - starts_a, stops_b - starts_b
    links = n_a * n_b
    small = np.flatnonzero(links <= SMALL_GROUP)
    group = np.repeat(small, links[small])
    place = np.arange(len(group)) - np.repeat(np.cumsum(links[small]) - links[small], links[small])
    keys = [owner[group] << 32 | a[starts_a[group] + place // n_b[group]] * WIDTH
            + b[starts_b[group] + place % n_b[group]]]
    weights = [np.ones(len(group), np.int64)]
    for i in np.flatnonzero(links > SMALL_GROUP):
        ids_a, times_a = np.unique(a[starts_a[i]:stops_a[i]], return_counts=True)
        ids_b, times_b = np.unique(b[starts_b[i]:stops_b[i]], return_counts=True)
        keys.append((owner[i] << 32 | np.add.outer(ids_a * WIDTH, ids_b)).ravel())
        weights.append(np.multiply.outer(times_a, times_b).ravel())
    return summed(np.concatenate(keys), np.concatenate(weights))


class Aligned:
    """Groups and links of one text, added up over its runs of units."""

    def __init__(self, with_groups: bool) -> None:
        self.counts = [0, 0, 0, 0]
        self.groups: list[str] | None = [] if with_groups else None
        self.keys, self.weights = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.digest: object | None = None

    def add(self, counts: Sequence[int], body: str, keys: np.ndarray, weights: np.ndarray) -> None:
        if self.digest is None:
            self.digest = hashlib.sha256(body.encode())
            self.keys, self.weights = keys, weights
        else:
            self.digest.update(b";" + body.encode())
            self.keys, self.weights = summed(np.r_[self.keys, keys], np.r_[self.weights, weights])
        if self.groups is not None:
            self.groups.append(body)
        self.counts = [x + y for x, y in zip(self.counts, [*counts, int(weights.sum())], strict=True)]

    @property
    def sha256(self) -> str:
        return "" if self.digest is None else self.digest.hexdigest()


def align_run(pair: Pair, found: Sequence[tuple[Aligned, Sequence[tuple[bytes, bytes]]]]) -> None:
    """Align texts, or parts of texts that end where tokens of both end, given as the ids of their units."""
    data = [[b"".join([unit[side] for unit in units_]) for _, units_ in found] for side in (0, 1)]
    a, b = (np.frombuffer(b"".join(x), np.int32).astype(np.int64) for x in data)
    texts_a, texts_b = (np.cumsum([len(x) // 4 for x in side]) for side in data)
    stops_a, stops_b = shared_groups(np.cumsum(pair.sizes_a[a]), np.cumsum(pair.sizes_b[b]), texts_a, texts_b)
    groups = np.searchsorted(stops_a, texts_a, side="right")
    sizes = np.diff(groups, prepend=0)
    listed = pc.binary_join_element_wise(
        group_texts(pair.names_a, a, stops_a), group_texts(pair.names_b, b, stops_b), "|")
    bodies = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[0, groups].astype(np.int32)), listed), ";")
    keys, weights = link_counts(a, b, stops_a, stops_b, np.repeat(np.arange(len(found)), sizes))
    at = np.searchsorted(keys >> 32, np.arange(len(found) + 1))
    keys &= (1 << 32) - 1
    counts = zip(np.diff(texts_a, prepend=0).tolist(), np.diff(texts_b, prepend=0).tolist(), sizes.tolist(), strict=True)
    for (text, _), three, body, x, y in zip(found, counts, bodies.to_pylist(), at[:-1], at[1:], strict=True):
        text.add(three, body, keys[x:y].copy(), weights[x:y].copy())


def align_texts(pair: Pair, cut: Sequence[list[str]], with_groups: bool = False) -> list[Aligned]:
    """Align texts given as their units. Runs of RUN_UNITS units are aligned at once; a longer text is cut between
    units, where tokens of both end."""
    get = pair.table.learn(cut)
    made = [Aligned(with_groups) for _ in cut]
    run: list[tuple[Aligned, Sequence[tuple[bytes, bytes]]]] = []
    size = 0
    for text, units_ in zip(made, cut, strict=True):
        ids = list(map(get, units_))
        if None in ids:
            continue
        for start in range(0, len(ids), RUN_UNITS):
            run.append((text, ids[start:start + RUN_UNITS]))
            size += len(run[-1][1])
            if size >= RUN_UNITS:
                align_run(pair, run)
                run, size = [], 0
    if run:
        align_run(pair, run)
    return made


# ---- blocks of documents -----------------------------------------------------------------

BLOCK = [StructField("kind", IntegerType()), StructField("block", LongType())]
PAIR = [StructField("code", IntegerType()), StructField("a", IntegerType()), StructField("b", IntegerType()),
        StructField("n_docs", LongType())]
DOC = [*[StructField(name, LongType()) for name in COUNTS], StructField("groups_sha256", StringType()),
       StructField("n_pairs", IntegerType()), StructField("links", BinaryType())]


def packed(codes: np.ndarray, weights: np.ndarray) -> bytes:
    """Ascending codes and their weights in few bytes."""
    data = np.diff(codes, prepend=0).astype("<i4").tobytes() + weights.astype("<i8").tobytes()
    return pa.compress(data, codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    body = pa.decompress(data, 12 * n, codec="zstd", asbytes=True)
    return np.cumsum(np.frombuffer(body, "<i4", n)), np.frombuffer(body, "<i8", n, 4 * n)


def aligned_blocks(docs: DataFrame, keep: Sequence[str], text: str, first: str, second: str, with_groups: bool
                   ) -> DataFrame:
    """Two kinds of rows: 0 one for each document, 1 one for each distinct id pair of a block of documents.

    A block is a run of rows of a task, of bounded bytes. A document holds its
    links as codes of its block's list of pairs, a pair how many of the block's
    documents have it.
    """
    state = "aligned", first, second
    source = docs.select(*[F.col(f"`{name}`").alias(f"keep {i}") for i, name in enumerate(keep)],
                         F.col(f"`{text}`").alias("text"))
    kept = [StructField(f.name, f.dataType) for f in source.schema.fields[:-1]]
    more = [StructField("groups", StringType())] if with_groups else []
    schema = StructType([*BLOCK, *kept, *DOC, *more, *PAIR])
    arrow = [pa.int32(), pa.int64(), *[None] * len(kept), *[pa.int64()] * len(COUNTS), pa.string(), pa.int32(), pa.binary(),
             *[pa.string()] * len(more), pa.int32(), pa.int32(), pa.int32(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = task_state(state, lambda: Pair(first, second))
        block = TaskContext.get().partitionId() << 32
        held: list[Aligned] = []
        rows: list[pa.RecordBatch] = []
        size = 0

        def nothing(n: int, types: Sequence[pa.DataType]) -> list[pa.Array]:
            return [pa.nulls(n, kind) for kind in types]

        def written() -> Iterator[pa.RecordBatch]:
            keys = np.concatenate([x.keys for x in held])
            listed, codes = np.unique(keys, return_inverse=True)
            n_docs = np.bincount(codes, minlength=len(listed))
            ends = np.cumsum([len(x.keys) for x in held])
            links = [packed(codes[end - len(x.keys):end], x.weights) for x, end in zip(held, ends.tolist(), strict=True)]
            columns = [pa.concat_arrays([part.column(i) for part in rows]) for i in range(len(kept))]
            n = len(held)
            made = [*[pa.array([x.counts[i] for x in held], pa.int64()) for i in range(len(COUNTS))],
                    pa.array([x.sha256 for x in held], pa.string()),
                    pa.array([len(x.keys) for x in held], pa.int32()), pa.array(links, pa.binary())]
            if with_groups:
                made.append(pa.array([";".join(x.groups) for x in held], pa.string()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, block)), *columns, *made, *nothing(n, arrow[-4:])],
                names=schema.names)
            m = len(listed)
            if m:
                blank = [*[pa.nulls(m, column.type) for column in columns], *nothing(m, arrow[2 + len(kept):-4])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ones(m, np.int32)), pa.array(np.full(m, block)), *blank,
                     pa.array(np.arange(m, dtype=np.int32)), pa.array((listed // WIDTH).astype(np.int32)),
                     pa.array((listed % WIDTH).astype(np.int32)), pa.array(n_docs.astype(np.int64))], names=schema.names)

        for batch in batches:
            for part in parts(batch, batch.num_columns - 1):
                data = [x.decode() for x in texts(part.column(batch.num_columns - 1))]
                cut = [units(" " + x) if x else [] for x in data]
                held.extend(align_texts(pair, cut, with_groups))
                rows.append(part)
                size += sum(map(len, data))
                if size >= BLOCK_BYTES or len(held) >= BLOCK_ROWS:
                    yield from written()
                    held, rows, size, block = [], [], 0, block + 1
        if held:
            yield from written()

    return source.mapInArrow(tidy(run, state), schema)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, n): how many documents of all blocks hold the id pair linked."""
    return blocks.where("kind = 1").groupBy("a", "b").agg(F.sum("n_docs").alias("n"))


def align_tokens(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", first: str = TOKENIZER,
                 second: str = pieces.MODEL, with_groups: bool = False) -> DataFrame:
    """``keep``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; ``with_groups`` adds groups.

    Tokens of ``first`` (A) encode a blank and the text, those of ``second``
    (B) the text; the offsets where tokens of both end cut them into groups,
    found by ``shared_groups``. All pairs of an A and a B token of a group are
    links. The count of an id pair is the number of rows of ``docs`` that hold
    it linked. n_best are the links whose count is the highest of their A id
    (ties included), count_sum is the sum of counts over the links.

    A null or empty text, and one that its tokens do not give back byte for
    byte (with a white space mark in it, say), has zeros and an empty digest.
    Every row is a document of its own. Texts are read once. Documents travel
    as the codes of their links in a block of bounded bytes, and only a
    block's distinct pairs meet the corpus-wide counts: a pair that stands in
    every document is one row a block there.
    """
    blocks = Stage(aligned_blocks(docs, keep, text, first, second, with_groups), "aligned", by=["kind"])
    pairs = docs.sparkSession.read.schema(blocks.df.schema).parquet(blocks.path).where("kind = 1")
    counts = Stage(pair_counts(pairs), "pairs").df
    # One row for each id of a vocabulary.
    best = F.broadcast(counts.groupBy("a").agg(F.max("n").alias("top")))
    marked = counts.join(best, "a").select("a", "b", "n", (F.col("n") == F.col("top")).alias("best"))
    listed = pairs.select("block", "code", "a", "b").join(marked, ["a", "b"]).select(
        "block", "code", "n", "best")
    names = [*COUNTS, "groups_sha256", *(["groups"] if with_groups else [])]
    kept = [f"keep {i}" for i in range(len(keep))]
    rows = blocks.df.where("kind = 0").select("block", *kept, *names, "n_pairs", "links")
    schema = StructType([*[rows.schema[name] for name in [*kept, *names]],
                         StructField("n_best", LongType()), StructField("count_sum", LongType())])

    def weigh(left: pa.Table, right: pa.Table) -> pa.Table:
        codes = right.column("code").to_numpy()
        counted, is_best = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
        counted[codes], is_best[codes] = right.column("n").to_numpy(), right.column("best").to_numpy()
        n_best, totals = [], []
        for n, data in zip(left.column("n_pairs").to_pylist(), left.column("links").to_pylist(), strict=True):
            own, weights = unpacked(data, n)
            n_best.append(int(weights @ is_best[own]))
            totals.append(int(weights @ counted[own]))
        return (left.select(schema.names[:-2]).append_column("n_best", pa.array(n_best, pa.int64()))
                .append_column("count_sum", pa.array(totals, pa.int64())))

    made = rows.groupBy("block").cogroup(listed.groupBy("block")).applyInArrow(weigh, schema)
    renamed = [F.col(f"`{place}`").alias(name) for place, name in zip(kept, keep, strict=True)]
    tail = ["groups_sha256", *(["groups"] if with_groups else [])]
    return made.select(*renamed, *COUNTS, "n_best", "count_sum", *tail)
