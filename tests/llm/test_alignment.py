from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np

from hearthspark.llm import alignment, pieces, queries, units
from tests.llm.data import SMALL, documents, given

POOL = "abcXYZ ÀéßİıſªµºñÑ0123²³¼ \t\n\r\x0b\x0c\x1c\x1f\x85\xa0'''stredmv.,!?#<|>_-̀日本Ⱥ\x00\x7f😀▁    "
ODD = ["", "▁", " ", "  ", "a ", "<|endoftext|> <s>", " " * 500 + "x" + " " * 333, "日本語" * 50, "it's  they'll\n\n  x ",
       "word " * 3000, "\t" * 200, "=" * 777]


def brute_force(pair, text):
    """(n_a, n_b, groups as text, links as a Counter) by merging all ends; none without tokens."""
    if not text:
        return None
    a, b = pair.ids_a(" " + text), pair.b.encode(text)
    bytes_a, bytes_b = [pair.bytes_a[i] for i in a], [pair.bytes_b[i] for i in b]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return None
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
    groups, links, i, j = [], Counter(), 0, 0
    for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
        i2, j2 = np.searchsorted(ends_a, end) + 1, np.searchsorted(ends_b, end) + 1
        groups.append(f"{','.join(map(str, a[i:i2]))}|{','.join(map(str, b[j:j2]))}")
        links.update((x, y) for x in a[i:i2] for y in b[j:j2])
        i, j = i2, j2
    return len(a), len(b), groups, links


def expected_rows(texts):
    pair = alignment.Pair(alignment.TOKENIZER, pieces.MODEL)
    found = [brute_force(pair, text) for text in texts]
    counts = Counter()
    for one in found:
        counts.update(one[3].keys() if one else ())
    top = defaultdict(int)
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    rows = []
    for one in found:
        if one is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = one
        rows.append((n_a, n_b, len(groups), sum(links.values()),
                     sum(n for link, n in links.items() if counts[link] == top[link[0]]),
                     sum(n * counts[link] for link, n in links.items()),
                     hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return rows


def values(row):
    return tuple(row[name] for name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))


def odd_texts():
    draw = random.Random(5)
    return ODD + ["".join(draw.choices(POOL, k=draw.randint(0, 40))) for _ in range(1500)]


def test_odd_texts_in_many_blocks(spark):
    texts = [*odd_texts(), "same row", "same row"]
    rows = [*enumerate(texts), (-1, None)]
    docs = documents(spark, rows, clash="n_links").repartition(5, "doc_id")
    found = {r["doc_id"]: values(r) for r in alignment.align_tokens(docs).collect()}
    assert found == dict(zip([i for i, _ in rows], expected_rows([text for _, text in rows]), strict=True))
    assert alignment.align_tokens(docs.limit(0)).count() == 0


def test_repeated_and_missing_ids(spark):
    found = alignment.align_tokens(documents(spark, [(1, "one"), (1, "two"), (None, "one")])).collect()
    assert sorted(values(r) for r in found) == sorted(expected_rows(["one", "two", "one"]))


def test_given_documents(spark):
    docs = given(spark, "documents").collect()
    expected = dict(zip([r["doc_id"] for r in docs], expected_rows([r["text"] for r in docs]), strict=True))
    assert {r["doc_id"]: values(r) for r in queries.op11_token_alignment(spark, SMALL).collect()} == expected


def test_runs_of_units_change_nothing(monkeypatch):
    pair = alignment.Pair(alignment.TOKENIZER, pieces.MODEL)
    cut = [units.units(" " + text) if text else [] for text in odd_texts()[:200]]
    whole = alignment.align_texts(pair, cut, with_groups=True)
    monkeypatch.setattr(alignment, "RUN_UNITS", 3)
    for one, other in zip(whole, alignment.align_texts(pair, cut, with_groups=True), strict=True):
        assert one.counts == other.counts and one.sha256 == other.sha256
        assert ";".join(one.groups) == ";".join(other.groups)
        assert np.array_equal(one.keys, other.keys) and np.array_equal(one.weights, other.weights)


def test_cuts_are_all_common_ends():
    draw = random.Random(9)
    for n in [1, 2, 3, 10, 100, 1000] * 20:
        share = draw.choice((0.02, 0.3, 0.9))
        a, b = (sorted({n, *[i for i in range(1, n) if draw.random() < share]}) for _ in range(2))
        stops_a, stops_b = alignment.shared_groups(np.array(a), np.array(b), np.array([len(a)]), np.array([len(b)]))
        common = sorted(set(a) & set(b))
        assert [a[i - 1] for i in stops_a] == common == [b[j - 1] for j in stops_b]


def test_a_run_of_blanks_links_by_counts():
    """Two tokenizers that never end together inside: links grow with the square, the listed pairs don't."""
    a, b = np.full(3000, 5), np.full(2000, 7)
    keys, weights = alignment.link_counts(a, b, np.array([3000]), np.array([2000]), np.array([0]))
    assert keys.tolist() == [5 * alignment.WIDTH + 7] and weights.tolist() == [6_000_000]
