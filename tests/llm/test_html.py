from __future__ import annotations

import html
import re

import pytest

from hearthspark.llm import html as html_module
from hearthspark.llm import queries
from hearthspark.llm.html import extract_main_text, main_text, smoothed, threshold
from tests.llm.data import SMALL, given

PAGE = """<html><head><title>No</title><style>p{}</style></head><body>
<header><a href=/>Site</a></header><nav><ul><li><a>One</a><li><a>Two</a></ul></nav>
<div class="cookie-notice">We use cookies</div>
<div id=main><h1>The  title</h1><p>A long paragraph &amp; more of it, with <b>bold</b> and <i>slanted</i> words.
<p>Short.<p>Another paragraph of some length, so that the region is dense in text.<script>var x = "<p>no</p>";</script>
<form><p>Your mail</p><input></form><div class="comments"><p>A reader says something long about all of this.</p></div>
</div><aside><p>Related things to read</p></aside><footer>&copy; us</footer></body></html>"""


def by_pattern(page: str) -> str:
    """The text of the given pages, whose article is one element of h1 and p."""
    article = re.search("<article>(.*)</article>", page, re.S)[1]
    blocks = re.split("</?(?:p|h1)>", article.replace("<br>", " "))
    cleaned = [" ".join(html.unescape(re.sub("<[^>]*>", "", block)).split()) for block in blocks]
    return "\n".join(block for block in cleaned if block)


def test_every_given_page(spark):
    found = {row["page_id"]: row for row in queries.op1_html_extraction(spark, SMALL).collect()}
    pages = given(spark, "pages").collect()
    assert len(found) == len(pages)
    for page in pages:
        assert found[page["page_id"]]["text"] == by_pattern(page["html"])
        assert found[page["page_id"]]["n_chars"] == len(by_pattern(page["html"]))


def test_surroundings_are_left_out():
    assert main_text(PAGE) == (
        "The title\nA long paragraph & more of it, with bold and slanted words.\nShort.\n"
        "Another paragraph of some length, so that the region is dense in text.")


@pytest.mark.parametrize("page", [
    "", "<", "<!", "<!--", "</", "<p", "<![CDATA[x", "<!foo", "<script>abc", "<a <b", "&#x110000;&#0;", "<p></p>",
    "<div>" * 5000 + "</p>" * 10, "</div></body>", "\x00", "<nav>only a menu</nav>",
])
def test_broken_pages(page):
    assert isinstance(main_text(page), str)


def test_table_cases(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, None, "<p>one</p>", "x"), (4, "u", "<p>one</p>", "x"),
            (4, "u", "<p>one</p>", "x"), (5, "u", "<article><p>" + "long text " * 200_000 + "</p></article>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = extract_main_text(pages).collect()
    assert sorted((row["page_id"] or 0, row["n_chars"]) for row in found) == [
        (0, 3), (1, 0), (2, 0), (4, 3), (4, 3), (5, 1_999_999)]
    assert extract_main_text(pages.limit(0)).count() == 0


def test_names_of_surroundings():
    for name in ("ad", "site-header", "sidebarLeft", "cookie_notice", "adBox", "reader-comments", "leftNav"):
        assert html_module.surrounding_name(name), name
    for name in ("has-sidebar", "no-ads-layout", "article-header", "content", "address", "header-less-with-menu", "lead"):
        assert not html_module.surrounding_name(name), name


def test_cluster_threshold():
    import numpy as np

    assert 2 < threshold(np.array([1.0, 1.0, 9.0, 10.0])) < 9
    assert threshold(np.array([3.0])) == 3
    assert np.allclose(smoothed(np.ones(5)), 1)


LONG = "A paragraph of the text that is long enough to be prose on any page, with several clauses, one after the other. "


@pytest.mark.parametrize("body", [
    "<main><h1>Title</h1><p>Lead.</p><article><p>{0}</p><p>{1}</p></article><p>{2}</p></main>",
    "<main><article><p>{0}</p></article><article><p>{1}</p><p>Short.</p></article></main>",
    "<article><p>{0}</p><article><p>{1}</p><p>{2}</p></article><p>Short.</p></article>",
    "<div><div><p>{0}</p><p>{1}</p><p>{2}</p></div><div><p>{3}</p></div><div><p>End.</p></div></div>",
    "<section><h2>One</h2><p>{0}</p></section><section><p>Short.</p></section><section><h2>Two</h2><p>{1}</p></section>",
    "<h1>Title</h1><p>By someone</p><article><p>{0}</p><p>{1}</p></article>",
    "<div class=title><h1>Title</h1></div><div><p>{0}</p><p>{1}</p></div>",
    "<div><p>{4}</p></div><div><p>{0}</p><p>{1}</p></div>",
])
def test_every_content_region_stays(body):
    body = body.format(*[f"{i} {LONG * (i + 1)}" for i in range(4)], LONG * 60)
    blocks = [" ".join(block.split()) for block in re.sub("</?[a-z0-9= ]+>", "\n", body).split("\n")]
    menu = "<nav><ul>" + "<li><a>One</a></li>" * 40 + "</ul></nav>"
    page = f"<body>{menu}{body}<div class=comments><p>{LONG}</p></div><footer>us</footer></body>"
    assert main_text(page).split("\n") == [block for block in blocks if block]


def test_links_outside_the_region_are_left_out():
    page = f"<ul><li><a>One</a><li><a>Two</a></ul><div><ul><li><a>Top</a></ul></div><div><p>{LONG * 3}</p><p><a>More</a></p></div>"
    assert main_text(page).split("\n") == [(LONG * 3).strip(), "More"]
