"""Quality of documents by attention-based multiple-instance learning over their passages."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructField

from hearthspark.llm.common import append, hashed_sample, texts

# Labelled documents that the model is fitted on, at most (chosen by a hash of their id).
TRAIN_DOCS = 4000
# A passage has this many words, or more where a document would have more than MOST_PASSAGES.
PASSAGE_WORDS = 64
MOST_PASSAGES = 32
HIDDEN, ATTENTION = 16, 8
ROUNDS, RATE, DECAY, BATCH = 60, 0.01, 1e-4, 128
CUT = 0.3
# Text handled at once; its arrays take some 80 times as much.
SLICE = 1 << 20

# Classes of bytes, from 0 on: the share of each in a passage is a feature.
CLASS_NAMES = ("space", "lower", "upper", "digit", "stop", "exclamation", "mark", "bar", "quote", "other", "wide",
               "control")
BYTE_CLASS = np.full(256, CLASS_NAMES.index("other"), dtype=np.int64)
for _name, _bytes in (
    ("wide", range(128, 256)), ("control", range(32)), ("space", b" \t\n\x0b\x0c\r"),
    ("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)), ("stop", b".,;:"),
    ("exclamation", b"!?"), ("mark", b"#$%&*@~^_=+"), ("bar", b"|/\\<>[]{}"), ("quote", b"\"'()`-"),
):
    BYTE_CLASS[list(_bytes)] = CLASS_NAMES.index(_name)
SPACE = CLASS_NAMES.index("space")
WORD_FEATURES = ("words", "word_bytes", "distinct", "repeated", "lines", "line_words", "ends_in_mark", "no_letter")
FEATURES = len(CLASS_NAMES) + len(WORD_FEATURES)

_powers: list[np.ndarray] = []


def powers(n: int) -> np.ndarray:
    """The first powers of an odd number modulo 2^64, for hashes of words."""
    if not _powers or len(_powers[0]) < n:
        with np.errstate(over="ignore"):
            _powers[:] = [np.cumprod(np.full(max(n, 256), 0x9E3779B97F4A7C15, dtype=np.uint64))]
    return _powers[0]


def passages(batch: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages (passage, feature) and the document each belongs to; every document has one at least."""
    data = np.frombuffer(b"".join(text + b"\n" for text in batch), dtype=np.uint8)
    kind = BYTE_CLASS[data]
    ends = np.cumsum([len(text) + 1 for text in batch])
    inside = kind != SPACE
    starts = np.flatnonzero(inside & ~np.append(False, inside[:-1]))
    stops = np.flatnonzero(inside & ~np.append(inside[1:], False)) + 1
    doc = np.searchsorted(ends, starts, side="right")
    words = np.bincount(doc, minlength=len(batch))
    first_word = np.cumsum(words) - words
    size = np.maximum(PASSAGE_WORDS, -(-words // MOST_PASSAGES))
    number = np.maximum(1, -(-words // size))
    first_passage = np.cumsum(number) - number
    total = int(number.sum())
    of_word = first_passage[doc] + (np.arange(len(starts)) - first_word[doc]) // size[doc]
    owner = np.repeat(np.arange(len(batch)), number)
    table = np.zeros((total, FEATURES), dtype=np.float32)
    if not len(starts):
        return table, owner
    # White space and all else up to the next word belongs to the passage of the word before it.
    span = np.append(starts[1:], len(data))
    last = np.append(doc[1:] != doc[:-1], True)
    span[last] = ends[doc[last]]
    length = span - starts
    byte_passage = np.repeat(of_word, length)
    at = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length) + np.repeat(starts, length)
    shares = np.bincount(byte_passage * len(CLASS_NAMES) + kind[at], minlength=total * len(CLASS_NAMES))
    shares = shares.reshape(total, len(CLASS_NAMES)).astype(np.float64)
    n_words = np.maximum(1, np.bincount(of_word, minlength=total))
    width = stops - starts
    place = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
    with np.errstate(over="ignore"):
        mixed = (data[place + np.repeat(starts, width)].astype(np.uint64) + np.uint64(1)) * powers(int(width.max()))[place]
        hashes = np.add.reduceat(mixed, np.cumsum(width) - width)
    order = np.lexsort((hashes, of_word))
    fresh = np.append(True, (hashes[order][1:] != hashes[order][:-1]) | (of_word[order][1:] != of_word[order][:-1]))
    again = np.append(False, (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1]))
    lines = np.bincount(byte_passage, weights=data[at] == 10, minlength=total)
    marked = np.isin(kind[stops - 1], [CLASS_NAMES.index(x) for x in ("mark", "exclamation", "bar", "other")])
    letters = np.isin(kind, [CLASS_NAMES.index(x) for x in ("lower", "upper", "wide")])
    lettered = np.add.reduceat(letters[place + np.repeat(starts, width)].astype(np.int64), np.cumsum(width) - width) > 0

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(of_word, weights=values, minlength=total) / n_words

    table[:, :len(CLASS_NAMES)] = shares / np.maximum(1, shares.sum(axis=1, keepdims=True))
    table[:, len(CLASS_NAMES):] = np.stack([
        np.log(n_words), np.log1p(mean(width)), np.bincount(of_word[order], weights=fresh, minlength=total) / n_words,
        mean(again), np.log1p(lines), np.log1p(n_words / (1 + lines)), mean(marked), mean(~lettered)], axis=1)
    return table, owner


@dataclass
class Attention:
    """A passage encoder, gated attention weights and a logistic score of the weighted mean of the encodings."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def score(self, table: np.ndarray, owner: np.ndarray, docs: int) -> np.ndarray:
        first = np.searchsorted(owner, np.arange(docs))
        out, _ = forward(self.weights, (table - self.mean) / self.scale, owner, first)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def forward(w: dict[str, np.ndarray], x: np.ndarray, owner: np.ndarray, first: np.ndarray
            ) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """Log-odds of each bag, and what the gradient needs."""
    h = np.tanh(x @ w["encode"] + w["encode_bias"])
    tanh = np.tanh(h @ w["value"])
    gate = 1 / (1 + np.exp(-(h @ w["gate"])))
    raw = (tanh * gate) @ w["attend"]
    top = np.maximum.reduceat(raw, first)
    e = np.exp(raw - top[owner])
    share = e / np.add.reduceat(e, first)[owner]
    bag = np.add.reduceat(h * share[:, None], first, axis=0)
    return bag @ w["out"] + w["out_bias"][0], (h, tanh, gate, share, bag)


def gradient(w: dict[str, np.ndarray], x: np.ndarray, owner: np.ndarray, first: np.ndarray, label: np.ndarray
             ) -> dict[str, np.ndarray]:
    """Of the mean logistic loss over the bags."""
    out, (h, tanh, gate, share, bag) = forward(w, x, owner, first)
    error = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - label) / len(label)
    d_bag = error[:, None] * w["out"]
    d_share = (h * d_bag[owner]).sum(axis=1)
    d_raw = share * (d_share - np.add.reduceat(share * d_share, first)[owner])
    d_mix = d_raw[:, None] * w["attend"]
    d_tanh, d_gate = d_mix * gate * (1 - tanh ** 2), d_mix * tanh * gate * (1 - gate)
    d_h = share[:, None] * d_bag[owner] + d_tanh @ w["value"].T + d_gate @ w["gate"].T
    d_in = d_h * (1 - h ** 2)
    return {"encode": x.T @ d_in, "encode_bias": d_in.sum(axis=0), "value": h.T @ d_tanh, "gate": h.T @ d_gate,
            "attend": (tanh * gate).T @ d_raw, "out": bag.T @ error, "out_bias": np.array([error.sum()])}


def train(table: np.ndarray, owner: np.ndarray, label: np.ndarray, rounds: int = ROUNDS, seed: int = 7) -> Attention:
    """Adam over mini-batches of bags. Bags are numbered from 0, their passages lie together."""
    rng = np.random.default_rng(seed)
    mean, scale = table.mean(axis=0), table.std(axis=0) + 1e-3
    x = ((table - mean) / scale).astype(np.float64)
    shapes = {"encode": (FEATURES, HIDDEN), "value": (HIDDEN, ATTENTION), "gate": (HIDDEN, ATTENTION)}
    w = {name: rng.normal(0, shape[0] ** -0.5, shape) for name, shape in shapes.items()}
    w |= {"encode_bias": np.zeros(HIDDEN), "attend": rng.normal(0, 0.1, ATTENTION), "out": rng.normal(0, 0.1, HIDDEN),
          "out_bias": np.zeros(1)}
    slow = {name: np.zeros_like(value) for name, value in w.items()}
    square = {name: np.zeros_like(value) for name, value in w.items()}
    bags = len(label)
    starts = np.searchsorted(owner, np.arange(bags + 1))
    step = 0
    for _ in range(rounds):
        order = rng.permutation(bags)
        for low in range(0, bags, BATCH):
            chosen = order[low:low + BATCH]
            counts = starts[chosen + 1] - starts[chosen]
            first = np.cumsum(counts) - counts
            rows = np.arange(int(counts.sum())) - np.repeat(first, counts) + np.repeat(starts[chosen], counts)
            found = gradient(w, x[rows], np.repeat(np.arange(len(chosen)), counts), first, label[chosen])
            step += 1
            for name, g in found.items():
                g = g + DECAY * w[name]
                slow[name] = 0.9 * slow[name] + 0.1 * g
                square[name] = 0.999 * square[name] + 0.001 * g * g
                w[name] = w[name] - RATE * (slow[name] / (1 - 0.9 ** step)) / (
                    np.sqrt(square[name] / (1 - 0.999 ** step)) + 1e-8)
    return Attention(mean, scale, w)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0; a row without an id is held out too."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> Attention:
    """The model, from at most ``most`` labelled documents that aren't held out, each with all its passages.

    A document has at most MOST_PASSAGES passages, so the driver gets at most
    ``most`` times that many rows of FEATURES numbers. A document with
    contradicting labels counts by their mean.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.avg("quality").alias("quality")))
    chosen = hashed_sample(known, most, known.count(), "doc_id")
    # At most ``most`` rows.
    bags = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    fields = [StructField("passages", ArrayType(FloatType()))]

    def make() -> Callable[[pa.Array], Sequence[pa.Array]]:
        def compute(column: pa.Array) -> Sequence[pa.Array]:
            table, owner = passages(texts(column))
            ends = np.searchsorted(owner, np.arange(len(column) + 1)) * FEATURES
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(table.ravel()))]

        return compute

    found = append(bags, make, fields, ["text"], ["doc_id", "quality"], measure="text", limit=SLICE)
    rows = sorted(found.dropDuplicates(["doc_id"]).toArrow().to_pylist(), key=lambda row: row["doc_id"])
    if not rows:
        rows = [{"quality": 0.5, "passages": [0.0] * FEATURES}]
    tables = [np.array(row["passages"], dtype=np.float32).reshape(-1, FEATURES) for row in rows]
    owner = np.repeat(np.arange(len(tables)), [len(x) for x in tables])
    return train(np.concatenate(tables), owner, np.array([row["quality"] for row in rows], dtype=float))


def score_quality(docs: DataFrame, labels: DataFrame, keep: Sequence[str] = ("doc_id",), cut: float = CUT) -> DataFrame:
    """``keep``, held_out, score (0 to 1, higher for label 1), predicted (score >= ``cut``) for every row.

    Scores come from the text alone. A null or empty text is one passage
    without words and gets that passage's score. Without any label to learn
    from every score is about a half.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def make() -> Callable[[pa.Array], Sequence[pa.Array]]:
        def compute(column: pa.Array) -> Sequence[pa.Array]:
            score = sent.value.score(*passages(texts(column)), len(column))
            return pa.array(score, pa.float64()), pa.array((score >= cut).astype(np.int32))

        return compute

    marked = docs.withColumn("held_out", held_out(F.col("doc_id")))
    fields = [StructField("score", DoubleType()), StructField("predicted", IntegerType())]
    return append(marked, make, fields, ["text"], [*keep, "held_out"], measure="text", limit=SLICE)
