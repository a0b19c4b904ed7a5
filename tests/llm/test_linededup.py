from __future__ import annotations

import hashlib

import pytest

from hearthspark.llm import linededup
from tests.llm.data import documents

WHITE = " \t\n\x0b\x0c\r"


def key_of(line: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def brute_force(rows):
    """(doc_id, n_lines, n_dropped, sha256) of each row."""
    holders: dict[str, set[int]] = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key_of(line)) >= 10:
                holders.setdefault(key_of(line), set()).add(doc)
    found = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or key_of(x) not in holders or min(holders[key_of(x)]) == doc]
        found.append((doc or -1, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(found)


CASES = [
    (5, "A shared line here\nown line of five"), (2, "a SHARED line here \r\nshort\nshort"), (9, "\tA shared line here"),
    (1, None), (3, ""), (4, "\n\n"), (7, "ééééééééé\nééééééééééé"), (8, "ééééééééé\nééééééééééÉ\nééééééééééé"),
    (6, "twice in one\ntwice in one\nTwice in one "), (10, "short\nshort\nexactly 10"), (11, "EXACTLY 10\nelse"),
    (12, "the same row again"), (12, "the same row again"), (None, "A shared line here"), (13, "\x00 odd \x1f line \x85"),
    (14, "\x00 odd \x1f line \x85"), (15, "x" * 300_000 + "\nA shared line here"), (16, "x" * 300_000),
]


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_against_brute_force(spark, batches):
    docs = documents(spark, CASES, clash="n_lines")
    found = linededup.dedup_lines(docs, batches=batches)
    assert sorted((r["doc_id"] or -1, r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in found.collect()
                  ) == brute_force(CASES)


def test_runs_are_compacted(spark):
    store = linededup.LineStore(spark, buckets=2)
    for i in range(7):
        lines = spark.createDataFrame([(i, 1, 1), (i, i + 10, 0)], "doc_id long, h1 long, h2 long")
        dropped, _ = store.admit(lines)
        assert [r["h1"] for r in dropped.collect()] == ([1] if i else [])
    assert len(store.runs()) < 7 and len(store.levels) > 1
    known = sorted(r["h1"] for run in store.runs() for r in run.df.where("not seen").collect())
    assert known == [1, *range(10, 17)]
    store.delete()


def test_a_line_in_every_document(spark):
    rows = [(i, f"a line that all have\nown line number {i}") for i in range(500)]
    found = linededup.dedup_lines(documents(spark, rows)).groupBy("n_dropped").count().collect()
    assert sorted((r["n_dropped"], r["count"]) for r in found) == [(0, 1), (1, 499)]


def test_stage_keeps_the_columns(spark):
    docs = documents(spark, CASES)
    kept = linededup.keep_lines(docs)
    assert kept.columns == docs.columns
    assert all(r["n_chars"] == len(r["text"] or "") for r in kept.collect())
    assert linededup.keep_lines(docs.limit(0)).count() == 0
