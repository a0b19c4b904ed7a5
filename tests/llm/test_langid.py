from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest

from hearthspark.llm import langid, queries
from tests.llm.data import SMALL, documents, given


@pytest.mark.parametrize("chunk", [1, 2, 3, 256])
def test_viterbi_is_the_best_path(chunk):
    rng = np.random.default_rng(chunk)
    for _ in range(60):
        lengths = rng.integers(1, 8, rng.integers(1, 6))
        firsts, states = np.cumsum(lengths) - lengths, int(rng.integers(1, 4))
        scores = rng.normal(size=(lengths.sum(), states)) * 3
        path = langid.viterbi(scores, firsts, 2.0, chunk)
        for start, n in zip(firsts, lengths, strict=True):
            def gain(p, start=start):
                return sum(scores[start + i, s] for i, s in enumerate(p)) - 2.0 * sum(a != b for a, b in itertools.pairwise(p))

            best = max(map(gain, itertools.product(range(states), repeat=int(n))))
            assert gain(path[start:start + n]) == pytest.approx(best)


def test_held_out_accuracy(spark):
    known = {r["doc_id"]: r["lang"] for r in given(spark, "documents").collect()}
    rows = queries.op5_language_id(spark, SMALL).collect()
    assert len(rows) == len(known)
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1)
        assert 0 <= row["score"] <= 1
    tested = [row for row in rows if row["held_out"]]
    assert np.mean([row["lang_pred"] == known[row["doc_id"]] for row in tested]) >= 0.98


def test_texts_without_letters_and_mixed_ones(spark):
    train = [(i, text, lang) for i in range(60) for text, lang in
             (("the cat and the dog with that thing", "en"), ("кот и собака это что он она", "ru"))]
    odd = [(-1, None, None), (-2, "", None), (-3, "123 !?", None), (-4, "日本語", None), (None, "the dog", None),
           (-5, "the cat and the dog with that thing кот и собака это что он она", None),
           (-6, "кот", "en"), (-7, "the cat " * 50_000, None)]
    docs = spark.createDataFrame([(i, t, lang, "x") for i, t, lang in train + odd],
                                 "doc_id long, text string, lang string, score string")
    rows = {r["doc_id"]: r for r in langid.identify_languages(docs, spans=True).collect()}
    assert [rows[i]["lang_pred"] for i in (-1, -2, -3)] == ["und"] * 3
    assert rows[-4]["lang_pred"] in ("en", "ru") and rows[-4]["score"] == 0
    assert rows[None]["lang_pred"] == "en" and rows[None]["held_out"]
    assert rows[-6]["lang_pred"] == "ru" and rows[-7]["lang_pred"] == "en"
    assert [(s["start"], s["end"], s["lang"]) for s in rows[-5]["spans"]] == [(0, 8, "en"), (8, 15, "ru")]
    kept = langid.keep_accepted(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect() if (r["doc_id"] or 0) < 0} == {-5, -6, -7}


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "some words"), (2, None)]).selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r["lang_pred"] for r in langid.identify_languages(docs).collect()} == {"und"}
    assert langid.identify_languages(docs.limit(0)).count() == 0


def test_scripts():
    found = langid.scripts_of(np.array([ord(c) for c in "aéжα日ก한ا"]))
    assert [langid.SCRIPT_NAMES[i] for i in found] == [
        "latin", "latin", "cyrillic", "greek", "han", "thai", "hangul", "arabic"]
    assert [start for start, _ in langid.SCRIPTS] == sorted(start for start, _ in langid.SCRIPTS)
