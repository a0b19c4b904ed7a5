"""Main text of web pages from streaming parser events, text-to-tag ratios, smoothing and threshold clustering."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, LongType, StringType, StructField

from hearthspark.llm.common import append, texts

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var".split()
)
# Elements whose text is never the article's.
LEFT_OUT = frozenset(
    "head script style noscript template nav header footer aside form button select option textarea input menu dialog "
    "iframe object svg canvas audio video map math".split()
)
# Words in a class, an id or a role that mark what surrounds an article.
SURROUNDINGS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
    "menu menubar breadcrumb breadcrumbs sidebar aside footer header masthead cookie cookies consent notice notices "
    "popup modal gdpr comment comments reply replies discussion disqus share sharing social related recommended "
    "newsletter subscribe subscription signup search toolbar pagination widget complementary contentinfo".split()
)
# Words that turn a mark into a remark on the layout ("has-sidebar"), or a header into an article's own.
LAYOUT = frozenset(("has", "with", "no", "without", "layout"))
OWN_HEADER = frozenset(("article", "post", "entry", "story"))
NAME_PARTS = re.compile("[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# An open paragraph or item that a new one ends, and the elements that such an end doesn't leave.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
        "th": ("td", "th")}
SCOPES = frozenset("html body article main section div td th table ul ol dl blockquote nav header footer aside form".split())
CONTAINERS = frozenset("body article main section div td".split())

# Characters a tag from which on a line is prose on any page, however long the page's longest paragraphs are.
PROSE = 40.0
SIGMA = 1.0


class Blocks(HTMLParser):
    """Turns parser events into lines (one per block of text) and the boxes (elements) they lie in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parents, self.names, self.hidden, self.linked = [0], [""], [False], [False]
        self.open = [0]
        # Box, text, tags before its end, and whether it has text outside links.
        self.lines: list[tuple[int, str, int, bool]] = []
        self.pieces: list[str] = []
        self.tags, self.own = 0, False

    def end_line(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            self.lines.append((self.open[-1], text, self.tags, self.own))
            self.tags = 0
        self.pieces.clear()
        self.own = False

    def shut(self, names: Sequence[str], within: frozenset[str]) -> None:
        """End the innermost open element of these names, without leaving an element of ``within``."""
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.names[self.open[depth]]
            if name in names:
                del self.open[depth:]
                return
            if name in within:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE and tag not in ("br", "wbr", "img"):
            self.end_line()
            self.shut(("p", *ENDS.get(tag, ())), SCOPES - {"td", "th"} if tag in ENDS else SCOPES)
        above = self.open[-1]
        if tag in VOID:
            self.tags += not self.hidden[above]
            if tag == "br":
                self.pieces.append(" ")
            return
        self.parents.append(above)
        self.names.append(tag)
        self.hidden.append(self.hidden[above] or self.marks_surroundings(tag, attrs))
        self.linked.append(tag == "a" or self.linked[above])
        self.open.append(len(self.names) - 1)
        # Tags of surroundings don't thin out the text behind them.
        self.tags += not self.hidden[-1]

    def marks_surroundings(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in LEFT_OUT:
            # The heading block of an article holds its title; only headings count there.
            return not (tag == "header" and any(self.names[i] in ("article", "main") for i in self.open))
        if tag in ("html", "body", "main"):
            return False
        for name, value in attrs:
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if name in ("class", "id", "role") and value and any(map(surrounding_name, value.split())):
                return True
        return False

    def handle_endtag(self, tag: str) -> None:
        self.tags += not self.hidden[self.open[-1]]
        if tag in INLINE:
            self.shut((tag,), SCOPES | {"p", "li"})
            return
        self.end_line()
        self.shut((tag,), SCOPES if tag in ("p", "li", *HEADINGS) else frozenset())

    def handle_data(self, data: str) -> None:
        if not self.hidden[self.open[-1]]:
            self.pieces.append(data)
            self.own = self.own or not self.linked[self.open[-1]] and not data.isspace()

    def unknown_decl(self, data: str) -> None:
        """A marked section, such as CDATA in a page of XML, is markup."""


def surrounding_name(name: str) -> bool:
    """Does a class, id or role name what surrounds an article?"""
    words = {word.lower() for word in NAME_PARTS.split(name)}
    if words & LAYOUT:
        return False
    return bool(words & (SURROUNDINGS - {"header"} if words & OWN_HEADER else SURROUNDINGS))


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian mean over neighbouring lines; at the ends only over the lines there are."""
    reach = int(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    wide = np.convolve(np.ones(len(ratios)), kernel)[reach:reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach:reach + len(ratios)] / wide


def threshold(values: np.ndarray) -> float:
    """The border between two clusters of values on a line, each value being with the nearer mean."""
    border = float(values.mean())
    for _ in range(64):
        high, low = values[values >= border], values[values < border]
        if not len(high) or not len(low):
            return border
        moved = (float(high.mean()) + float(low.mean())) / 2
        if moved == border:
            return border
        border = moved
    return border


def main_lines(page: str) -> list[str]:
    """The blocks of the main part of a page, in page order.

    Lines above the threshold of the smoothed text-to-tag ratios select the
    content. The region is the smallest container that holds all text whose
    own ratio is above it too, or the outermost article or main around that;
    all its lines stay, whatever their ratio. Of what stands outside, these
    stay: lines that are selected or lie directly in a container around the
    region, mere links apart, and the headings right before the region.
    """
    parser = Blocks()
    parser.feed(page)
    parser.close()
    parser.end_line()
    names, parents = parser.names, parser.parents
    lines = [x for x in parser.lines if not in_heading_block(x[0], names, parents)]
    if not lines:
        return []
    ratios = np.array([len(text) / max(1, tags) for _, text, tags, _ in lines])
    own = np.array([alone for *_, alone in lines])
    smooth = smoothed(ratios)
    border = threshold(smooth)
    selected = smooth >= border
    # A short line beside long ones is selected with them, but doesn't widen the region.
    spanning = own & (ratios >= min(border, PROSE))
    held = [0] * len(names)
    for (box, *_), spans in zip(lines, (spanning if spanning.any() else selected).tolist(), strict=True):
        held[box] += spans
    for box in range(len(names) - 1, 0, -1):
        held[parents[box]] += held[box]
    # The boxes that hold all of them are nested; the last is the innermost.
    region = max(box for box, n in enumerate(held) if n == held[0])
    while region and names[region] not in CONTAINERS:
        region = parents[region]
    around = {0, region}
    box = region
    while box:
        box = parents[box]
        around.add(box)
        if names[box] in ("article", "main"):
            region = box
    inside, container, headed = [not region], [0], [False]
    for box in range(1, len(names)):
        above = parents[box]
        inside.append(box == region or inside[above])
        container.append(box if names[box] in CONTAINERS else container[above])
        headed.append(names[box] in HEADINGS or headed[above])
    kept = [inside[box] or alone and (taken or container[box] in around)
            for (box, _, _, alone), taken in zip(lines, selected.tolist(), strict=True)]
    before = next(i for i, (box, *_) in enumerate(lines) if inside[box]) - 1
    while before >= 0 and headed[lines[before][0]]:
        kept[before] = True
        before -= 1
    return [line[1] for line, stays in zip(lines, kept, strict=True) if stays]


def in_heading_block(box: int, names: Sequence[str], parents: Sequence[int]) -> bool:
    """Is it text of a header element, other than a heading?"""
    heading = False
    while box:
        heading = heading or names[box] in HEADINGS
        if names[box] == "header":
            return not heading
        box = parents[box]
    return False


def main_text(page: str) -> str:
    return "\n".join(main_lines(page))


def extract_main_text(pages: DataFrame, html: str = "html", keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """``keep``, and for every page: text, n_chars (code points), n_blocks.

    A null or empty page, or one without visible text, gives an empty text.
    Every row gives one row; repeated pages give equal rows. Pages of any
    length are parsed whole, without a limit, one page at a time.
    """

    def make() -> Callable[[pa.Array], Sequence[pa.Array]]:
        def compute(column: pa.Array) -> Sequence[pa.Array]:
            blocks = [main_lines(page.decode("utf-8", "replace")) for page in texts(column)]
            found = ["\n".join(lines) for lines in blocks]
            return (pa.array(found, pa.string()), pa.array([len(text) for text in found], pa.int64()),
                    pa.array([len(lines) for lines in blocks], pa.int32()))

        return compute

    fields = [StructField("text", StringType()), StructField("n_chars", LongType()),
              StructField("n_blocks", IntegerType())]
    return append(pages, make, fields, [html], keep, measure=html)
