"""Language of documents and of the spans of mixed ones: script ranges, word scores and a Viterbi path."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

from hearthspark.llm.common import append, parts, texts, tidy

# Documents of each language that the model is fitted on, at most (chosen by a hash of their id).
TRAIN_PER_LANGUAGE = 2000
BUCKETS = 1 << 15
# Natural-log score that a change of language costs.
SWITCH = 6.0
# Letters of a language that a script must have for its words to be candidates.
SCRIPT_SHARE = 0.001
# A document is accepted if at least this share of its letters is in its language.
ACCEPT = 0.4
CHUNK = 256
# Text handled at once; its arrays take some 80 times as much.
SLICE = 1 << 20
UNKNOWN = "und"

# First code points of Unicode script ranges, in order.
SCRIPTS = (
    (0x0000, "other"), (0x0041, "latin"), (0x0250, "phonetic"), (0x0300, "other"), (0x0370, "greek"),
    (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "syriac"),
    (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"),
    (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"),
    (0x1800, "mongolian"), (0x18B0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "armenian"),
    (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"), (0xFF00, "other"),
    (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"), (0x32000, "other"),
)
SCRIPT_NAMES = tuple(dict.fromkeys(name for _, name in SCRIPTS))

_tables: dict[str, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """By code point: is it a letter?"""
    if "letters" not in _tables:
        _tables["letters"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _tables["letters"]


def scripts_of(codes: np.ndarray) -> np.ndarray:
    """Script numbers of code points."""
    if "scripts" not in _tables:
        _tables["starts"] = np.array([start for start, _ in SCRIPTS])
        _tables["scripts"] = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])
    return _tables["scripts"][np.searchsorted(_tables["starts"], codes, side="right") - 1]


@dataclass
class Words:
    """The words (runs of letters, lower-cased) of some texts, with the hashed trigrams around their letters."""

    doc: np.ndarray
    size: np.ndarray
    script: np.ndarray
    grams: np.ndarray
    begins: np.ndarray

    @classmethod
    def of(cls, batch: Sequence[str], buckets: int = BUCKETS) -> Words:
        lowered = [text.lower() for text in batch]
        codes = np.frombuffer("\n".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        codes = codes.astype(np.int64)
        letter = letter_table()[codes]
        shown = np.where(letter, codes, 32)
        places = np.flatnonzero(letter)
        before = np.zeros(len(codes), dtype=bool)
        before[1:] = letter[:-1]
        starts = np.flatnonzero(letter & ~before)
        begins = np.searchsorted(places, starts)
        mixed = shown[places - 1] * 1_000_003 + shown[places] * 8_191 + shown[places + 1] * 131
        grams = (mixed ^ (mixed >> 15)) % buckets
        limits = np.cumsum([1, *[len(text) + 1 for text in lowered]])
        return cls(np.searchsorted(limits, starts, side="right") - 1, np.diff(begins, append=len(places)),
                   scripts_of(codes[starts]), grams, begins)


@dataclass
class Model:
    """Languages, log-probabilities of trigram buckets (bucket, language), and the languages of each script."""

    languages: list[str]
    scores: np.ndarray
    prior: np.ndarray
    allowed: np.ndarray

    def emissions(self, words: Words) -> np.ndarray:
        """Score of each word in each language; languages that don't use its script are out of the question."""
        if not len(words.begins):
            return np.zeros((0, len(self.languages)), dtype=np.float32)
        total = np.add.reduceat(self.scores[words.grams], words.begins, axis=0)
        fits = self.allowed[words.script]
        # A word in a script of none of the languages says nothing.
        fits = fits | ~fits.any(axis=1, keepdims=True)
        silent = ~self.allowed[words.script].any(axis=1)
        total[silent] = 0
        return np.where(fits, total, np.float32(-1e6)).astype(np.float32)


def viterbi(scores: np.ndarray, firsts: np.ndarray, switch: float = SWITCH, chunk: int = CHUNK) -> np.ndarray:
    """The best state of each word, with ``switch`` taken off for each change of state within a document.

    ``firsts`` has where each document's words begin. All documents advance
    together: each is cut into chunks of words, for each chunk the best path
    from every first to every last state is found, and chunks are then linked
    exactly, so that a very long document takes no more steps than a chunk.
    """
    number, states = scores.shape
    labels = np.zeros(number, dtype=np.int64)
    if not number:
        return labels
    ends = np.append(firsts[1:], number)
    counts = -(-(ends - firsts) // chunk)
    owner = np.repeat(np.arange(len(firsts)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = firsts[owner] + within * chunk
    length = np.minimum(chunk, ends[owner] - start)
    order = np.argsort(-length, kind="stable")
    start_sorted, length_sorted = start[order], length[order]
    same = np.arange(states)
    best = np.full((len(order), states, states), -np.inf)
    best[:, same, same] = scores[start_sorted]
    back = np.zeros((number, states, states), dtype=np.uint8)
    for step in range(1, int(length_sorted[0])):
        alive = int(np.searchsorted(-length_sorted, -step, side="left"))
        now = best[:alive]
        top = now.max(axis=2, keepdims=True) - switch
        moved = top > now
        places = start_sorted[:alive] + step
        back[places] = np.where(moved, now.argmax(axis=2)[:, :, None], same)
        best[:alive] = np.where(moved, top, now) + scores[places][:, None, :]
    paths = np.empty_like(best)
    paths[order] = best
    entry = np.zeros(len(owner), dtype=np.int64)
    leave = np.zeros(len(owner), dtype=np.int64)
    last = np.cumsum(counts) - 1
    for doc, final in enumerate(last):
        if not counts[doc]:
            continue
        first = final - counts[doc] + 1
        gain = paths[first]
        begun = [gain.argmax(axis=0)]
        reached = gain.max(axis=0)
        before = []
        for c in range(first + 1, final + 1):
            source = int(reached.argmax())
            jump = reached[source] - switch > reached
            before.append(np.where(jump, source, same))
            total = np.where(jump, reached[source] - switch, reached)[:, None] + paths[c]
            begun.append(total.argmax(axis=0))
            reached = total.max(axis=0)
        state = int(reached.argmax())
        for k in range(final - first, -1, -1):
            leave[first + k] = state
            entry[first + k] = state = int(begun[k][state])
            if k:
                state = int(before[k - 1][state])
    state = leave[order]
    entered = entry[order]
    for step in range(int(length_sorted[0]) - 1, -1, -1):
        alive = int(np.searchsorted(-length_sorted, -step, side="left"))
        places = start_sorted[:alive] + step
        labels[places] = state[:alive]
        if step:
            state[:alive] = back[places, entered[:alive], state[:alive]]
    return labels


def training_rows(docs: DataFrame) -> Column:
    """Rows whose language may be learned: crc32 of the id as text, modulo 3, is not 1."""
    return ~held_out(F.col("doc_id")) & F.col("lang").isNotNull()


def held_out(doc_id: Column) -> Column:
    """A row without an id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def fit(docs: DataFrame, per_language: int = TRAIN_PER_LANGUAGE, buckets: int = BUCKETS) -> Model:
    """Trigram scores of each language from about ``per_language`` whole documents of it, chosen by a hash.

    Counts are summed on the executors; at most buckets x languages numbers
    reach the driver. The number of languages is taken to be bounded.
    """
    rows = docs.where(training_rows(docs)).select("doc_id", "lang", "text")
    sizes = {row["lang"]: row["n"] for row in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, per_language / sizes[lang]))]
                         ) if languages else F.lit(None)
    chosen = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)
                        ) if languages else rows.limit(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = np.zeros((len(languages), buckets), dtype=np.int64)
        scripts = np.zeros((len(languages), len(SCRIPT_NAMES)), dtype=np.int64)
        for batch in batches:
            for part in parts(batch, 1, SLICE):
                words = Words.of([x.decode("utf-8", "replace") for x in texts(part.column(1))], buckets)
                own = np.array([languages.index(x) for x in part.column(0).to_pylist()], dtype=np.int64)
                by_word = own[words.doc]
                by_gram = np.repeat(by_word, words.size)
                grams += np.bincount(by_gram * buckets + words.grams, minlength=grams.size).reshape(grams.shape)
                scripts += np.bincount(by_word * scripts.shape[1] + words.script, weights=words.size,
                                       minlength=scripts.size).astype(np.int64).reshape(scripts.shape)
        whole = np.concatenate((grams, scripts), axis=1)
        place = np.flatnonzero(whole)
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(whole.ravel()[place], pa.int64())],
                                         names=["place", "n"])

    schema = StructType([StructField("place", LongType()), StructField("n", LongType())])
    counted = chosen.select("lang", "text").mapInArrow(tidy(run), schema).groupBy("place").agg(F.sum("n").alias("n"))
    whole = np.zeros((len(languages), buckets + len(SCRIPT_NAMES)))
    for row in counted.toLocalIterator() if languages else ():
        whole.flat[row["place"]] = row["n"]
    grams, scripts = whole[:, :buckets] + 0.5, whole[:, buckets:]
    scores = np.log(grams / grams.sum(axis=1, keepdims=True)).T if languages else np.zeros((buckets, 0))
    # Only differences between languages count.
    scores = (scores - scores.mean(axis=1, keepdims=True)).astype(np.float32) if languages else scores
    total = np.maximum(1, scripts.sum(axis=1, keepdims=True))
    prior = np.array([sizes[lang] for lang in languages], dtype=float)
    return Model(languages, scores, prior, (scripts / total >= SCRIPT_SHARE).T)


SPAN = StructType([StructField("start", IntegerType()), StructField("end", IntegerType()),
                   StructField("lang", StringType())])


def label_languages(docs: DataFrame, model: Model, keep: Sequence[str] | None = None, text: str = "text",
                    spans: bool = False) -> DataFrame:
    """``keep`` (all columns by default), lang_pred, score and, if asked for, the spans of words by language.

    lang_pred has most letters on the best path over the words, score is its
    share of all letters. A null text, or one without a letter, is ``und``
    with score 0. A letter of a script that no learned language uses counts
    for none; a text of such letters only gets the commonest language, with
    score 0. Without a learned language every text is ``und``. Spans are
    [start, end) in words.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[pa.Array], Sequence[pa.Array]]:
        def compute(column: pa.Array) -> Sequence[pa.Array]:
            own = sent.value
            words = Words.of([x.decode("utf-8", "replace") for x in texts(column)])
            docs_here, states = len(column), len(own.languages)
            path = np.zeros(len(words.doc), dtype=np.int64)
            score, names = np.zeros(docs_here), [UNKNOWN] * docs_here
            if states:
                path = viterbi(own.emissions(words), np.unique(words.doc, return_index=True)[1])
                known = words.size * own.allowed[words.script].any(axis=1)
                letters = np.bincount(words.doc * states + path, weights=known, minlength=docs_here * states
                                      ).reshape(docs_here, states)
                every = np.bincount(words.doc, weights=words.size, minlength=docs_here)
                chosen = np.where(letters.any(axis=1), letters.argmax(axis=1), own.prior.argmax())
                score = np.where(every > 0, letters[np.arange(docs_here), chosen] / np.maximum(every, 1), 0.0)
                names = [own.languages[c] if n else UNKNOWN for c, n in zip(chosen, every, strict=True)]
            made = [pa.array(names, pa.string()), pa.array(score, pa.float64())]
            if spans:
                made.append(span_lists(words.doc, path, own.languages, docs_here))
            return made

        return compute

    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    if spans:
        fields.append(StructField("spans", ArrayType(SPAN)))
    return append(docs, make, fields, [text], keep, measure=text, limit=SLICE)


def span_lists(doc: np.ndarray, path: np.ndarray, languages: Sequence[str], docs: int) -> pa.Array:
    """Runs of words with one language, by document."""
    rows: list[list[dict[str, object]]] = [[] for _ in range(docs)]
    if len(doc) and languages:
        first = np.searchsorted(doc, np.arange(docs))
        cuts = np.flatnonzero((np.diff(doc) != 0) | (np.diff(path) != 0)) + 1
        for start, end in zip(np.append(0, cuts).tolist(), np.append(cuts, len(doc)).tolist(), strict=True):
            base = int(first[doc[start]])
            rows[doc[start]].append({"start": start - base, "end": end - base, "lang": languages[path[start]]})
    return pa.array(rows, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])))


def identify_languages(docs: DataFrame, keep: Sequence[str] = ("doc_id",), spans: bool = False) -> DataFrame:
    """``keep``, held_out, lang_pred, score for every row, by a model learned from the rows that aren't held out."""
    model = fit(docs)
    marked = docs.withColumn("held_out", held_out(F.col("doc_id")))
    return label_languages(marked, model, [*keep, "held_out"], spans=spans)


def keep_accepted(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """The rows whose language is known: not ``und``, and at least ``accept`` of the letters in one language."""
    labelled = label_languages(docs.withColumnsRenamed({"lang_pred": "in lang_pred", "score": "in score"}), fit(docs))
    kept = labelled.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= accept)).drop("lang_pred", "score")
    return kept.withColumnsRenamed({"in lang_pred": "lang_pred", "in score": "score"}).select(*docs.columns)
