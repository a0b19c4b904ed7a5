"""Licence notices: exact phrases, and short notices with a bounded number of edits."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from hearthspark.llm.common import append, ascii_words, texts

# Exact phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Short notices, as words, and their labels. A notice may have one edit for each CHARS_PER_EDIT characters, MAX_EDITS at
# most.
NOTICES = {
    "all rights reserved": "reserved",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "licensed under the apache license version 2 0": "apache-2.0",
    "mozilla public license version 2 0": "mpl-2.0",
    "eclipse public license": "epl",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under cc by sa": "cc-by-sa",
    "licensed under cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "dedicated to the public domain": "public-domain",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "proprietary and confidential": "proprietary",
    "may not be reproduced without permission": "proprietary",
}
CHARS_PER_EDIT = 8
MAX_EDITS = 3

SPAN = StructType([StructField("label", StringType()), StructField("start", LongType()),
                   StructField("end", LongType()), StructField("edits", IntegerType())])


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """The notice cut into edits + 1 pieces: with so many edits one of them stands in the text as it is."""
    size, extra = divmod(len(notice), edits + 1)
    cut, start = [], 0
    for i in range(edits + 1):
        stop = start + size + (i < extra)
        cut.append((start, notice[start:stop]))
        start = stop
    return cut


@dataclass(frozen=True)
class Match:
    """Words ``start`` to ``end`` (exclusive) that are a notice but for some edits."""

    label: str
    start: int
    end: int
    edits: int
    likeness: float


class Scanner:
    """Finds phrases and notices in one text. Built once per task."""

    def __init__(self, phrases: Mapping[str, str] = PHRASES, notices: Mapping[str, str] = NOTICES,
                 chars_per_edit: int = CHARS_PER_EDIT, max_edits: int = MAX_EDITS) -> None:
        self.phrases = phrases
        self.notices = []
        entries: dict[str, list[tuple[int, int]]] = {f" {phrase} ": [] for phrase in phrases}
        for number, (notice, label) in enumerate(notices.items()):
            edits = min(max_edits, len(notice) // chars_per_edit)
            pattern = regex.compile(f"(?b)(?<![^ ])(?:{regex.escape(notice)}){{e<={edits}}}(?![^ ])")
            self.notices.append((notice, label, edits, pattern))
            for offset, piece in pieces(notice, edits):
                entries.setdefault(piece, []).append((number, offset))
        self.seeds = ahocorasick.Automaton()
        for entry, places in entries.items():
            self.seeds.add_word(entry, (entry, places))
        self.seeds.make_automaton()

    def scan(self, text: bytes) -> tuple[int, list[tuple[str, int]], list[Match]]:
        """The number of words, every (label, first word) of a phrase, and the notices."""
        words = ascii_words(text)
        line = f" {b' '.join(words).decode('utf-8', 'replace')} "
        exact: list[tuple[str, int]] = []
        windows: dict[int, list[tuple[int, int]]] = {}
        for last, (entry, places) in self.seeds.iter(line):
            start = last + 1 - len(entry)
            if entry[0] == " " and entry.strip() in self.phrases and entry == f" {entry.strip()} ":
                exact.append((self.phrases[entry.strip()], line.count(" ", 0, start)))
            for number, offset in places:
                notice, _, edits, _ = self.notices[number]
                low = start - offset - edits
                windows.setdefault(number, []).append((max(0, low), low + len(notice) + 2 * edits))
        return len(words), exact, best_apart([match for number, found in windows.items()
                                              for match in self.verified(line, number, found)])

    def verified(self, line: str, number: int, windows: list[tuple[int, int]]) -> list[Match]:
        """Notices within the candidate windows, each reported once."""
        notice, label, edits, pattern = self.notices[number]
        found: dict[int, Match] = {}
        joined: list[list[int]] = []
        for low, high in sorted(windows):
            if joined and low <= joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], high)
            else:
                joined.append([low, high])
        for low, high in joined:
            # A window ends with whole words.
            last = line.find(" ", high)
            parts = [(max(0, line.rfind(" ", 0, low + 1)), last + 1 or len(line))]
            while parts:
                first, stop = parts.pop()
                # The best match need not be the first one: the parts before and behind it are searched too.
                match = pattern.search(line, first, stop)
                if not match or match.start() == match.end():
                    continue
                parts += [(a, b) for a, b in ((first, match.start()), (match.end(), stop)) if a < b]
                changed = sum(match.fuzzy_counts)
                start = line.count(" ", 0, match.start()) - (line[match.start()] != " ")
                end = line.count(" ", 0, match.end()) - (line[match.end() - 1] == " ")
                found.setdefault(start, Match(label, start, end, changed, 1 - changed / len(notice)))
        return list(found.values())


def best_apart(matches: list[Match]) -> list[Match]:
    """Of notices that overlap the likest (then the longest) one, in text order."""
    taken: list[Match] = []
    for match in sorted(matches, key=lambda m: (-m.likeness, m.start - m.end, m.start, m.label)):
        if all(match.end <= other.start or other.end <= match.start for other in taken):
            taken.append(match)
    return sorted(taken, key=lambda m: m.start)


def scan_licenses(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text",
                  phrases: Mapping[str, str] = PHRASES, notices: Mapping[str, str] = NOTICES,
                  chars_per_edit: int = CHARS_PER_EDIT, max_edits: int = MAX_EDITS) -> DataFrame:
    """``keep``, and for every text: n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    Base columns count the places where a phrase's words stand consecutively:
    n_base of them, their smallest and largest first word (null if none).
    ``labels`` adds those of notices found with at most one edit for each
    ``chars_per_edit`` characters and ``max_edits`` in all. score is the best likeness, 1 - edits /
    length, of all finds (a phrase has 1, no find 0). spans lists the notices
    as words [start, end). Labels are distinct, sorted and comma-joined. A null
    or empty text has no words; every row gives one row.
    """

    def make() -> Callable[[pa.Array], Sequence[pa.Array]]:
        scanner = Scanner(phrases, notices, chars_per_edit, max_edits)

        def compute(column: pa.Array) -> Sequence[pa.Array]:
            rows = []
            for data in texts(column):
                n_words, exact, matches = scanner.scan(data)
                base = {label for label, _ in exact}
                starts = [start for _, start in exact]
                rows.append((
                    n_words, len(exact), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                    ",".join(sorted(base | {match.label for match in matches})),
                    1.0 if exact else max((match.likeness for match in matches), default=0.0),
                    [{"label": m.label, "start": m.start, "end": m.end, "edits": m.edits} for m in matches]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
                     pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                         ("edits", pa.int32())])))
            return [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]

        return compute

    fields = [StructField("n_words", LongType()), StructField("n_base", LongType()),
              StructField("first_word", LongType()), StructField("last_word", LongType()),
              StructField("base_labels", StringType()), StructField("labels", StringType()),
              StructField("score", DoubleType()), StructField("spans", ArrayType(SPAN))]
    return append(docs, make, fields, [text], keep, measure=text)
