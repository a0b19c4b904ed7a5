from __future__ import annotations

import random
import zlib

import numpy as np

from hearthspark.llm import packing, queries, tokens
from tests.llm.data import SMALL, documents, given

POOL = "abcXYZ ÀéßİıſªµºñÑ0123²³¼ \t\n\r\x0b\x0c\x1c\x1f\x85\xa0'''stredmv.,!?#<|>_-̀日本Ⱥ\x00\x7f"
ODD = ["", "it's <|endoftext|>x", "<|startoftext|>", "  a  b", "'S 'T don'T", "\x1c\x1c a", "a" * 20_000, " " * 5_000]


def odd_texts() -> list[str]:
    draw = random.Random(1)
    latin = [c for c in POOL if ord(c) < 0x180]
    return ODD + ["".join(draw.choices(pool, k=draw.randint(0, 40))) for pool in (POOL, latin) for _ in range(4000)]


def test_ids_are_the_librarys():
    texts = odd_texts()
    library = tokens.load("byte_bpe_50k.json").encode_batch(texts, add_special_tokens=False)
    assert tokens.encoder("byte_bpe_50k.json")(texts) == [tokens.id_bytes(x.ids) for x in library]


def test_cache_of_two_generations(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 50)
    texts = odd_texts()[:1500]
    library = tokens.load("byte_bpe_50k.json").encode_batch(texts, add_special_tokens=False)
    encode = tokens.encoder("byte_bpe_50k.json")
    made = [ids for i in range(0, len(texts), 100) for ids in encode(texts[i:i + 100])]
    assert made == [tokens.id_bytes(x.ids) for x in library]


def test_counts_are_the_librarys(spark):
    texts = odd_texts()
    docs = documents(spark, [*enumerate(texts), (-1, None), (None, "a b"), (7, "repeated id")], clash="n_tokens")
    found = {r["doc_id"]: r for r in tokens.count_tokens(docs, frequent=64).collect() if r["doc_id"] not in (7, None)}
    library = tokens.load("word_bpe_49k.json").encode_batch(texts, add_special_tokens=False)
    for i, (text, ids) in enumerate(zip(texts, library, strict=True)):
        if i != 7:
            assert (found[i]["n_bytes"], found[i]["n_tokens"]) == (len(text.encode()), len(ids.ids))
            assert found[i]["over_limit"] == (len(ids.ids) > 2048)
    assert (found[-1]["n_bytes"], found[-1]["n_tokens"]) == (0, 0)
    assert tokens.count_tokens(docs.limit(0)).count() == 0


def test_repeated_long_run_of_letters(spark):
    run = "".join(random.Random(2).choices("abcdefghijklmnopqrstuvwxyz", k=130_000))
    docs = documents(spark, [(i, f"{run} and more") for i in range(6)])
    expected = len(tokens.load("word_bpe_49k.json").encode(f"{run} and more", add_special_tokens=False).ids)
    assert expected > 65_535
    assert [r["n_tokens"] for r in tokens.count_tokens(docs).collect()] == [expected] * 6
    assert tokens.frequent_pre_tokens(docs, "text", "word_bpe_49k.json") == ["and", "more"]


def test_counts_of_all_given_documents(spark):
    docs = given(spark, "documents").collect()
    library = tokens.load("word_bpe_49k.json").encode_batch([r["text"] or "" for r in docs], add_special_tokens=False)
    expected = sorted((r["doc_id"], len(x.ids)) for r, x in zip(docs, library, strict=True))
    assert sorted((r["doc_id"], r["n_tokens"]) for r in queries.op3_token_counts(spark, SMALL).collect()) == expected


def check_packed(rows, texts):
    """Every id of every document in one piece, sequences gapless, of a power of two, and of one document."""
    library = tokens.load("byte_bpe_50k.json")
    by_doc: dict[int, list] = {}
    sequences: dict[int, list] = {}
    for row in rows:
        by_doc.setdefault(row["doc_id"], []).append(row)
        sequences.setdefault(row["sequence_id"], []).append(row)
    assert by_doc.keys() == texts.keys()
    for doc, pieces in by_doc.items():
        ids = np.array([*library.encode(texts[doc] or "", add_special_tokens=False).ids, 0], dtype="<u4").tobytes()
        at = 0
        for piece in sorted(pieces, key=lambda r: r["start"]):
            assert piece["start"] == at and piece["doc_tokens"] == len(ids) // 4
            at += piece["length"]
            assert zlib.crc32(ids[4 * piece["start"]:4 * at]) == piece["ids_crc32"]
        assert at == len(ids) // 4
    assert sorted(sequences) == list(range(len(sequences)))
    lengths = []
    for number in sorted(sequences):
        (piece,) = sequences[number]
        assert piece["offset"] == 0 and piece["length"] <= 1024 and piece["length"] & (piece["length"] - 1) == 0
        lengths.append(piece["length"])
    assert lengths == sorted(lengths, reverse=True)


def test_packing_of_all_given_documents(spark):
    docs = {r["doc_id"]: r["text"] for r in given(spark, "documents").collect()}
    check_packed(queries.op7_packing(spark, SMALL).collect(), docs)


def test_packing_cases(spark):
    texts = {1: None, 2: "", 3: "a " * 1023, 4: "a " * 1022, 5: "<|endoftext|>", 6: "日本" * 3000}
    docs = documents(spark, list(texts.items()), clash="length")
    check_packed(packing.pack(docs).collect(), texts)
    assert packing.pack(docs.limit(0)).count() == 0
    twice = packing.pack(documents(spark, [(1, "same row"), (1, "same row"), (None, "no id")])).collect()
    assert len({r["sequence_id"] for r in twice}) == len(twice)


def test_binary_pieces():
    for n in range(1, 5000):
        pieces = packing.binary_pieces(n)
        assert sum(length for _, length in pieces) == n
        assert [start for start, _ in pieces] == [sum(x for _, x in pieces[:i]) for i in range(len(pieces))]
        assert len([length for _, length in pieces if length < 1024]) == bin(n % 1024).count("1")
