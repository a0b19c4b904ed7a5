from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from hearthspark.llm import phrases, queries
from tests.comparison import difference, duck
from tests.llm.data import SMALL, documents

PLACES = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_force(rows, support=10, longest=3, share=50, top=2000):
    counts: dict[str, Counter] = defaultdict(Counter)
    sizes: Counter = Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", lower(text or "")):
            words = re.findall("[^ \t]+", piece)
            sizes[lang or "und"] += len(words)
            for m in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    found = []
    for lang, f in counts.items():
        cands = {p: n for p, n in f.items() if len(p) > 1 and n >= support}
        kept = []
        for p, a in cands.items():
            inside = any(len(q) > len(p) and 100 * n >= share * a and
                         any(q[i:i + len(p)] == p for i in range(len(q))) for q, n in cands.items())
            if not inside:
                score, _, left, right = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                            for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(found)


def corpus(seed: int, n: int):
    draw = random.Random(seed)
    words = ["The", "the", "of", "a", "é", "日本", "x\x85y", "\x1c", "in spite", "new\tyork", "as well as", "b.c", "\x00"]
    made = [(draw.choice(["en", "en", "de", None, "und"]),
             "".join(draw.choice(words) + draw.choice([" ", "  ", "\t", " ", ", ", "\n"]) for _ in range(draw.randint(0, 40))))
            for _ in range(n)]
    return [*made, ("en", None), ("fr", ""), ("xx", "alone here"), (None, "a b " * 40), ("zz", "p q " * 9)]


def frame(spark, rows):
    df = documents(spark, [(i, text) for i, (_, text) in enumerate(rows)], clash="score").drop("lang")
    langs = spark.createDataFrame([(i, lang) for i, (lang, _) in enumerate(rows)], "doc_id long, lang string")
    return df.join(langs, "doc_id")


def result(df):
    return sorted(tuple(r[name] for name in PLACES) for r in df.collect())


@pytest.mark.parametrize("shard", [16 << 20, 900])
def test_against_brute_force(spark, monkeypatch, shard):
    """One shard a task with a high local support, and very many with a local support of 1."""
    monkeypatch.setattr(phrases, "SHARD_BYTES", shard)
    rows = corpus(1, 400)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3, "text")
    source = phrases.Stage(docs, "docs").df
    assert result(phrases.collocations(source)) == brute_force(rows)


def test_longer_phrases_and_other_bounds(spark):
    rows = corpus(2, 300)
    docs = phrases.Stage(frame(spark, rows), "docs").df
    found = phrases.collocations(docs, support=5, longest=4, share=80, top=7)
    assert result(found) == brute_force(rows, 5, 4, 80, 7)


def test_full_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MOST_BITS", 1024)
    rows = corpus(3, 200)
    docs = phrases.Stage(frame(spark, rows), "docs").df
    assert result(phrases.collocations(docs)) == brute_force(rows)


def test_no_rows(spark):
    empty = documents(spark, [(1, "")])
    assert phrases.collocations(empty).count() == 0
    assert phrases.collocations(empty.limit(0)).count() == 0


def test_given_documents_equal_their_sql(spark):
    assert difference(queries.op12_collocations(spark, SMALL), duck(SMALL), queries.COLLOCATIONS_SQL) is None


def test_local_supports_leave_less_than_the_support():
    draw = random.Random(4)
    for _ in range(300):
        sizes = [draw.randint(1, 1000) for _ in range(draw.randint(1, 40))]
        least = [phrases.local_support(10, n, sum(sizes)) for n in sizes]
        assert sum(t - 1 for t in least) < 10 and min(least) >= 1


def test_filter_knows_all_its_keys(spark):
    keys = [i * 7_777_777_777_777 - 2**62 for i in range(5000)]
    made = phrases.KeyFilter.of(spark.createDataFrame([(k,) for k in keys], "key long"), len(keys))
    assert made.has(np.array(keys, np.int64).view(np.uint64)).all()
    others = np.arange(100_000, dtype=np.uint64) * np.uint64(977) + np.uint64(5)
    assert made.has(others).mean() < 0.02


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 999_999_999_999_937, 999_999_999_999_989, 1_000_000_000_000_037
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(
        phrases.floored_score("a", "l", "r").alias("score")).first()
    assert row["score"] == 1_000_000 * a * a // (left * right)
