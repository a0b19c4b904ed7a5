from __future__ import annotations

import re

from hearthspark.llm import queries
from hearthspark.llm.licenses import PHRASES, Scanner, pieces, scan_licenses
from tests.llm.data import SMALL, documents, given

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def base_columns(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    found = [(label, i) for phrase, label in PHRASES.items() for i in range(len(words))
             if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for _, i in found]
    return (len(words), len(found), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for label, _ in found})))


CASES = [
    None, "", "CC-BY cc by", "cc by cc by", "All rights reserved. ALL RIGHTS  RESERVED", "ccby", "cc byé", "écc by",
    "x general public license", "general\npublic-license v3 under GNU General Public License",
    "All rihgts reservd", "Releasd under the MIT Licence!", "Licensed under CC BY-NC 4.0.",
    "Licensed under the Apache License, Version 2.0.", "word " * 100_000 + "all rights reserved",
]


def test_base_columns(spark):
    docs = documents(spark, list(enumerate(CASES)), clash="score")
    for row in scan_licenses(docs).collect():
        got = tuple(row[x] for x in ("n_words", "n_base", "first_word", "last_word", "base_labels"))
        assert got == base_columns(CASES[row["doc_id"]])
        assert 0 <= row["score"] <= 1 and (row["score"] > 0) == bool(row["labels"])
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
    assert scan_licenses(docs.limit(0)).count() == 0


def test_base_columns_of_all_given_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in given(spark, "documents").collect()}
    for row in queries.op4_license_scan(spark, SMALL).collect():
        got = tuple(row[x] for x in ("n_words", "n_base", "first_word", "last_word", "base_labels"))
        assert got == base_columns(texts[row["doc_id"]])


def test_notices_with_edits():
    scanner = Scanner()
    for text, label, span in (
        ("so: All rights reservd.", "reserved", (1, 4)), ("Releasd under the MIT Licence!", "mit", (0, 5)),
        ("x Licensed under the Apache Licence, version 2.0", "apache-2.0", (1, 9)),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc", (0, 5)),
    ):
        (match,) = scanner.scan(text.encode())[2]
        assert (match.label, (match.start, match.end)) == (label, span)
    for text in ("all writers observed", "released under pressure", "rights and licenses", "nothing at all"):
        assert scanner.scan(text.encode())[2] == []


def test_pieces_cover_a_notice():
    for edits in range(4):
        cut = pieces("licensed under it", edits)
        assert len(cut) == edits + 1 and "".join(piece for _, piece in cut) == "licensed under it"


def test_no_match_within_the_budget_is_missed():
    """Against the bounded-error pattern run over the whole line."""
    scanner = Scanner()
    texts = ["all rigths reserved", "allrights reserved", "gnu general pubilc license", "licensed unde the mit licens",
             "creative comons attribution", "eclipse publik license x", "proprietary an confidential"]
    for text in texts:
        line = f" {text} "
        whole = {number for number, (_, _, _, pattern) in enumerate(scanner.notices) if pattern.search(line)}
        labels = {scanner.notices[number][1] for number in whole}
        found = {match.label for match in scanner.scan(text.encode())[2]}
        assert found <= labels and bool(found) == bool(labels)


def test_edited_notice_before_a_better_one():
    def found(text):
        return [(m.label, m.start, m.end, m.edits) for m in Scanner().scan(text)[2]]

    assert found(b"licensd under the mit license licensed under the mit license") == [("mit", 0, 5, 1), ("mit", 5, 10, 0)]
    assert found(b"creatve commons attribution creative commons attribution noncommercial") == [
        ("cc-by", 0, 3, 1), ("cc-by-nc", 3, 7, 0)]
