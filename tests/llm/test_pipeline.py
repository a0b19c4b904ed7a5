from __future__ import annotations

import pytest

import __spark_entry__
import corpus_pipeline
from hearthspark.llm import langid
from tests.comparison import difference, duck
from tests.llm import test_decontaminate, test_linededup, test_simhash, test_tokens
from tests.llm.data import SMALL, given

NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


def test_each_stage_against_brute_force(spark):
    """Stage after stage, each on all that the one before kept."""
    docs = given(spark, "documents")
    items = [(r["item_id"], r["text"]) for r in given(spark, "benchmark").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert [*stages] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]

    known = langid.label_languages(docs, langid.fit(docs)).collect()
    kept = stages["language_id"](spark, docs, SMALL)
    assert kept.columns == docs.columns
    first = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert first.keys() == {r["doc_id"] for r in known if r["lang_pred"] != "und" and r["score"] >= langid.ACCEPT}

    lines = stages["line_dedup"](spark, kept, SMALL)
    assert lines.columns == docs.columns
    second = {r["doc_id"]: r["text"] for r in lines.collect()}
    holders: dict[str, int] = {}
    for doc in sorted(first):
        for line in first[doc].split("\n"):
            holders.setdefault(test_linededup.key_of(line), doc)
    assert second == {doc: "\n".join(x for x in text.split("\n") if len(test_linededup.key_of(x)) < 10
                                     or holders[test_linededup.key_of(x)] == doc) for doc, text in first.items()}

    near = stages["near_dedup"](spark, lines, SMALL)
    assert near.columns == docs.columns
    third = {r["doc_id"]: r["text"] for r in near.collect()}
    assert third.keys() == {component for _, _, component in test_simhash.expected_rows(list(second.items()))}

    clean = stages["decontamination"](spark, near, SMALL)
    assert clean.columns == docs.columns
    fourth = {r["doc_id"]: r["text"] for r in clean.collect()}
    bad = {doc for doc, *_, contaminated in test_decontaminate.brute_force(list(third.items()), items) if contaminated}
    assert fourth.keys() == third.keys() - bad and bad

    test_tokens.check_packed(corpus_pipeline.run(spark, SMALL).collect(), fourth)


@pytest.mark.parametrize("name", [name for name in __spark_entry__.oracle_sql() if name.startswith("op")])
def test_query_against_sql(spark, name):
    found = difference(__spark_entry__.queries()[name](spark, SMALL), duck(SMALL), __spark_entry__.oracle_sql()[name])
    assert found is None, found


def test_all_eleven_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    assert all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 11))
