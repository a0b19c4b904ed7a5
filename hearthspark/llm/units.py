"""Cutting texts where public tokenizers never join what lies on both sides, and tables of what the parts become."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

# Parts longer than this are computed anew each time: a table of them would have no bound worth the name.
LONGEST_KEPT = 256
# Bytes of a generation of a table, keys and an estimate of the values together.
TABLE_BYTES = 64 << 20
# What a Python dict entry with a short key and a short value takes besides their characters.
ENTRY_BYTES = 300

# White space of any pattern library, and characters whose class differs between them: a blank behind one of these may
# share a token with it.
_UNSURE = "\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff\u2581"
_UNIT = re.compile(f" (?:[^ ]+|(?<=[{_UNSURE}]) )*")
_VISIBLE_END = re.compile(f"[^{_UNSURE}]\\Z")
_CHUNK = re.compile(" +[^ ]*")

MARK = "\u2581"


def units(text: str) -> list[str]:
    """Parts of a text that begins with a blank, cut before each blank that follows a visible character.

    There a byte-level tokenizer ends a pre-token and a tokenizer with white
    space marks ends a piece, whatever stands around: each part has the tokens
    it has in the whole text.
    """
    return _UNIT.findall(text)


def ends_visibly(unit: str) -> bool:
    """Whether a blank may be put behind ``unit`` without a token that holds both."""
    return _VISIBLE_END.search(unit, len(unit) - 1) is not None


def marked_words(text: str) -> list[str]:
    """The words of a text as a tokenizer with white space marks sees them, each with the blanks before it.

    The mark the tokenizer puts before the first word is a blank here; marks
    in the text are blanks to it as well. Joined, the words give the text
    behind one blank; an empty text has none.
    """
    return _CHUNK.findall(" " + text.replace(MARK, " ")) if text else []


class DistinctTable:
    """Values of distinct parts, each computed once while it is in the table.

    The table has two generations of bounded bytes: when the young one is full
    it becomes the old one, and parts that are still met move back from there.
    Parts over LONGEST_KEPT characters live for one ``learn`` only.
    """

    def __init__(self, compute: Callable[[list[str]], Iterable], limit: int = TABLE_BYTES) -> None:
        self.compute, self.limit = compute, limit
        self.known: dict[str, object] = {}
        self.old: dict[str, object] = {}
        self.long: list[str] = []
        self.bytes = 0

    def learn(self, cut: Sequence[Sequence[str]]) -> Callable[[str], object]:
        """Know all parts of these texts; returns the lookup."""
        for part in self.long:
            del self.known[part]
        if self.bytes > self.limit:
            self.old, self.known, self.bytes = self.known, {}, 0
        new = set().union(*cut).difference(self.known)
        recalled = {part: self.old[part] for part in new if part in self.old}
        self.known.update(recalled)
        rest = list(new.difference(recalled))
        self.known.update(zip(rest, self.compute(rest), strict=True))
        self.long = [part for part in rest if len(part) > LONGEST_KEPT]
        self.bytes += ENTRY_BYTES * len(new) + 4 * (sum(map(len, new)) - sum(map(len, self.long)))
        return self.known.__getitem__
