"""Encoding and decoding by a table of distinct marked words.

Where no piece of a SentencePiece model has a white space mark behind another
character, pieces cannot cross from one marked word into the next. Then a text
is segmented by segmenting each distinct marked word once and joining the ids
back by position, and decoded by joining the decoded words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField
from sentencepiece import SentencePieceProcessor

from hearthspark.llm.common import append, task_state, texts
from hearthspark.llm.units import MARK, DistinctTable, marked_words

MODEL = "piece_bpe_32k.model"


def load(name: str) -> SentencePieceProcessor:
    """The model, if its words can be segmented one by one."""
    model = SentencePieceProcessor(model_file=public_tokenizers.path(name))
    for i in range(model.vocab_size()):
        if MARK in model.id_to_piece(i).lstrip(MARK):
            raise ValueError(f"{name}: the piece {model.id_to_piece(i)!r} crosses a white space mark")
    # A mark before the first word, none lost and no character changed: what marked_words relies on.
    if model.decode(model.encode("  a\n b\u3000\ufb01 ")) != "  a\n b\u3000\ufb01 " or model.encode("a")[0] != model.encode(
            "b a")[-1]:
        raise ValueError(f"{name}: the model normalizes its input")
    return model


def word_ids(model: SentencePieceProcessor, words: Sequence[str]) -> list[list[int]]:
    """Ids of each marked word. The library puts back the first blank, which is cut off; a lone blank is one piece."""
    alone = [model.piece_to_id(MARK)]
    return [ids if word != " " else alone
            for word, ids in zip(words, model.encode([word[1:] for word in words], num_threads=1), strict=True)]


def segmenter(model: SentencePieceProcessor) -> Callable[[list[str]], list[tuple[int, str, str]]]:
    """(number of ids, ids as text, decoded text behind the first blank) of each marked word."""

    def run(words: list[str]) -> list[tuple[int, str, str]]:
        if not words:
            return []
        found = word_ids(model, words)
        return [(len(ids), ",".join(map(str, ids)), text)
                for ids, text in zip(found, model.decode(found, num_threads=1), strict=True)]

    return run


def encode_decode(docs: DataFrame, name: str = MODEL, keep: Sequence[str] = ("doc_id",), text: str = "text",
                  with_text: bool = False) -> DataFrame:
    """``keep``, and for every text: n_tokens, ids_sha256, decoded_sha256; ``with_text`` adds ids and decoded.

    Ids are those of the library for the whole text, without begin or end
    ids; ids_sha256 is the digest of the ids in decimal, joined by commas,
    decoded_sha256 that of the text the library makes of them. A task keeps a
    table of the distinct marked words it met (of bounded bytes, see
    ``DistinctTable``), segments and decodes what is new through the library in
    one call per slice of text, and joins the values back by position: no text
    and no word is shuffled. A null or empty text has no ids and decodes to an
    empty text. A word of any length is segmented whole.
    """
    state = "pieces", name

    def make() -> Callable[[pa.Array], Sequence[pa.Array]]:
        table = task_state(state, lambda: DistinctTable(segmenter(load(name))))

        def compute(column: pa.Array) -> Sequence[pa.Array]:
            cut = [marked_words(data.decode()) for data in texts(column)]
            get = table.learn(cut)
            counts, ids, decoded = [], [], []
            for words in cut:
                sizes, numbers, parts = zip(*map(get, words), strict=True) if words else ((), (), ())
                counts.append(sum(sizes))
                ids.append(",".join(numbers))
                decoded.append(" ".join(parts))
            digests = [[hashlib.sha256(value.encode()).hexdigest() for value in values] for values in (ids, decoded)]
            more = [ids, decoded] if with_text else []
            return [pa.array(counts, pa.int64()), *[pa.array(values, pa.string()) for values in (*digests, *more)]]

        return compute

    names = ["ids_sha256", "decoded_sha256", *(["ids", "decoded"] if with_text else [])]
    fields = [StructField("n_tokens", LongType()), *[StructField(name, StringType()) for name in names]]
    return append(docs, make, fields, [text], keep, measure=text, state=state)
