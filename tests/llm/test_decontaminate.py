from __future__ import annotations

import hashlib
import random
import re

import pytest

from hearthspark.llm.decontaminate import drop_contaminated, find_contamination
from tests.llm.data import documents

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(rows, items):
    """(doc_id, n_words, n_hit, n_items, sha256, contaminated)."""
    found = []
    for doc, text in rows:
        words = words_of(text)
        hit, ids = set(), set()
        for item, body in items:
            own = words_of(body)
            if item is None or not own:
                continue
            n = min(13, len(own))
            windows = {tuple(own[i:i + n]) for i in range(len(own) - n + 1)}
            for i in range(len(words) - n + 1):
                if tuple(words[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    ids.add(str(item))
        listed = ",".join(sorted(ids))
        found.append((doc or -1, len(words), len(hit), len(ids), hashlib.sha256(listed.encode()).hexdigest(),
                      len(hit) > 0 and 20 * len(hit) >= len(words)))
    return sorted(found)


def cases():
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)] + ["the", "of", "é"]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.choice((3, 8, 13, 14, 40))))) for i in range(12)]
    items += [(20, None), (21, ""), (22, "!?"), (None, "w1 w2"), (2, items[2][1]), (2, "a second text of the same item"),
              (30, "the the the the the the the the the the the the the the")]
    rows = []
    for i in range(60):
        words = draw.choices(vocabulary, k=draw.randint(0, 120))
        for _ in range(draw.randint(0, 3)):
            _, body = draw.choice(items)
            cut = words_of(body)
            start = draw.randint(0, max(0, len(cut) - 13))
            place = draw.randint(0, len(words))
            words[place:place] = cut[start:start + draw.choice((5, 13, 20))]
        rows.append((i, ", ".join(words).title()))
    rows += [(100, None), (101, ""), (102, items[0][1]), (102, items[0][1]), (None, items[1][1]),
             (103, "the " * 3000), (104, "x " * 50_000 + items[4][1])]
    return rows, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_against_brute_force(spark, block_bytes):
    rows, items = cases()
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    docs = documents(spark, rows, clash="n_words")
    found = find_contamination(docs, benchmark, block_bytes=block_bytes).collect()
    assert sorted((r["doc_id"] or -1, r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
                  for r in found) == brute_force(rows, items)
    for row in found:
        assert len(row["items"]) == row["n_items"]
        assert len({i for s in row["spans"] for i in range(s["start"], s["end"])}) == row["n_hit"]


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"
    texts = [(1, f"x {item} y"), (2, item.replace("zeta", "other")), (3, item.replace("zeta", "very zeta")),
             (4, item.replace("zeta", "x").replace("eta", "y").replace("mu", "z")), (5, "alpha nu"),
             (6, "alpha beta gamma delta epsilon"), (7, "zeta eta theta iota kappa lambda mu nu")]
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = {r["doc_id"]: r for r in find_contamination(documents(spark, texts), benchmark, proximity=(1, 1)).collect()}
    assert {i for i, r in found.items() if r["items"]} == {1}
    assert {i for i, r in found.items() if r["near_items"]} == {1, 2, 3}


def test_empty_tables(spark):
    rows, items = cases()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, rows)
    assert find_contamination(docs.limit(0), benchmark).count() == 0
    assert {r["n_hit"] for r in find_contamination(docs, benchmark.limit(0)).collect()} == {0}


def test_contaminated_documents_go(spark):
    rows, items = cases()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, rows)
    kept = drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    bad = {(doc or -1, n) for doc, n, *_, contaminated in brute_force(rows, items) if contaminated}
    expected = sorted(doc or -1 for doc, text in rows if (doc or -1, len(words_of(text))) not in bad)
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == expected
