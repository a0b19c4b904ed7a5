from __future__ import annotations

import hashlib
import random

from hearthspark.llm import pieces, queries, units
from tests.llm.data import SMALL, documents, given

POOL = "abcXYZ ÀéßıſªµºñÑ0123² \t\n\r\x0b\x0c\x1c\x1f\x85\xa0'stredmv.,!?#<|>_-̀日本Ⱥ\x00\x7f▁😀　    "
ODD = ["", " ", "   ", "▁", "▁ ▁", "a ", " a", "a  b", "<s> </s>", "<0x41>", "x" * 50_000, " " * 5_000, "word " * 20_000]


def odd_texts() -> list[str]:
    draw = random.Random(3)
    return ODD + ["".join(draw.choices(POOL, k=draw.randint(0, 40))) for _ in range(6000)]


def digest(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest()


def brute_force(texts):
    model = pieces.load(pieces.MODEL)
    found = []
    for text in texts:
        ids = model.encode(text or "")
        found.append((len(ids), digest(",".join(map(str, ids))), digest(model.decode(ids) if ids else "")))
    return found


def values(row):
    return row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]


def test_whole_texts_give_the_librarys_ids(spark):
    texts = odd_texts()
    docs = documents(spark, [*enumerate(texts), (-1, None), (7, "same id"), (None, "no id")], clash="n_tokens")
    found = pieces.encode_decode(docs).collect()
    assert len(found) == len(texts) + 3
    by_id = {r["doc_id"]: values(r) for r in found if r["doc_id"] not in (7, None)}
    expected = brute_force(texts)
    assert all(by_id[i] == expected[i] for i in range(len(texts)) if i != 7)
    assert by_id[-1] == (0, digest(""), digest(""))
    assert [values(r) for r in found if r["doc_id"] is None] == brute_force(["no id"])
    assert pieces.encode_decode(docs.limit(0)).count() == 0


def test_given_documents(spark):
    docs = given(spark, "documents").collect()
    expected = dict(zip([r["doc_id"] for r in docs], brute_force([r["text"] for r in docs]), strict=True))
    assert {r["doc_id"]: values(r) for r in queries.op13_pieces(spark, SMALL).collect()} == expected


def test_texts_are_kept_on_request(spark):
    (row,) = pieces.encode_decode(documents(spark, [(1, "two words")]), with_text=True).collect()
    assert row["decoded"] == "two words" and len(row["ids"].split(",")) == row["n_tokens"]


def test_a_small_table_forgets_and_learns_again():
    model = pieces.load(pieces.MODEL)
    table = units.DistinctTable(pieces.segmenter(model), limit=3000)
    texts = odd_texts()[:900]
    most = 0
    for i in range(0, len(texts), 10):
        cut = [units.marked_words(text) for text in texts[i:i + 10]]
        get = table.learn(cut)
        most = max(most, len(table.known) + len(table.old))
        for text, words in zip(texts[i:i + 10], cut, strict=True):
            assert ",".join(get(word)[1] for word in words) == ",".join(map(str, model.encode(text)))
    assert most < 400


def test_each_distinct_word_is_segmented_once():
    asked: list[str] = []

    def compute(words):
        asked.extend(words)
        return words

    table = units.DistinctTable(compute)
    for text in ("a b a", "b c", "a b c d", "a"):
        table.learn([units.marked_words(text)])
    assert sorted(asked) == [" a", " b", " c", " d"]
