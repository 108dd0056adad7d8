from __future__ import annotations

import re
import time
from html import unescape

import pyarrow.parquet as pq

from clicklens.llm.html import extract_text, main_text

SF = "/root/testdata/sf0.01"
PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site</h1><a href=/>Home</a></header><div id="cookie-notice">We use cookies.</div>
<nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav><main><div class="content">
<article><h1>Head &amp;\n line</h1><p>First <b>bold</b>\n  text &lt;here&gt;.<p>Short.
<ul><li>point one<li>point two</ul><blockquote>Said.</blockquote><script>x = "<p>no</p>"</script>
<form><input><p>Sign up</p></form><p>Last &eacute;nd.</article></div>
<aside><p>A sidebar with quite a long text that is not of the article at all.</p></aside>
<section class="comments"><p>I disagree with all of it, and at length too.</p></section></main>
<div class="ad">Buy now</div><footer>&copy; site</footer></body></html>"""


def test_the_article_and_nothing_else():
    assert main_text(PAGE).split("\n") == [
        "Head & line", "First bold text <here>.", "Short.", "point one", "point two",
        "Said.", "Last énd.",
    ]


def test_pages_without_marks_of_their_parts():
    links = "".join(f"<li><a href=/{i}>Item number {i}</a></li>" for i in range(20))
    text = "A sentence of the text that is long enough to be dense. " * 5
    html = f"<div><ul>{links}</ul></div><div><div><p>{text}</p><p>{text}</p></div></div>"
    assert main_text(html).split("\n") == [text.strip()] * 2


def test_odd_pages(spark):
    rows = [
        (1, "u", None), (2, None, ""), (None, "u", "just text &amp; more"), (4, "u", "<p>unclosed <b>x"),
        (5, "u", "<" * 50), (6, "u", "<div>" * 3000 + "deep"), (7, "u", "<script>only()</script>"),
        (8, "u", "</p></div>stray"), (8, "u", "</p></div>stray"), (9, "u", "<p>" + "long word " * 50_000),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS n_chars")
    found = {r["page_id"]: r["text"] for r in extract_text(pages).collect()}
    assert extract_text(pages).count() == len(rows)
    assert (found[1], found[2], found[7]) == ("", "", "")
    assert found[None] == "just text & more" and found[4] == "unclosed x"
    assert found[6] == "deep" and found[8] == "stray" and len(found[9]) == 499_999
    assert extract_text(pages.limit(0)).count() == 0


def test_whole_articles_of_the_test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    for row in extract_text(pages).collect():
        article = re.search("<article>(.*)</article>", html[row["page_id"]], re.DOTALL)[1]
        blocks = [unescape(re.sub("<[^>]+>", " ", b)) for b in re.split("</?(?:p|h1)>", article)]
        assert row["text"] == "\n".join(" ".join(b.split()) for b in blocks if b.strip())
        assert row["n_chars"] == len(row["text"])


LONG = "<p>" + "A sentence of an article that goes on for a while. " * 8 + "</p>"


def test_articles_with_unlucky_names():
    text = LONG[3:-4].strip()
    side = '<div class="sidebar"><p>See also this and that.</p></div>'
    for page in (
        f'<div class="content no-sidebar">{LONG}</div>{side}',
        f'<article class="post has-comments">{LONG}</article>{side}',
        f'<article><p id="related-work">{text}</p></article>{side}',
        f"<form>{LONG}</form>{side}",
        f'<div class="widget">{LONG}</div>{side}',
        f'<svg width="1"/><article>{LONG}</article>{side}',
        f"<svg><article>{LONG}</article>{side}",
        f"<article><svg-icon name=x></svg-icon>{LONG}</article>{side}",
    ):
        assert main_text(page) == text, page[:40]
    assert main_text(f"<article>{LONG}<p>so <math><mi>x</mi></math> is</p></article>").endswith("so x is")


def test_time_grows_with_the_page():
    def seconds(part, n):
        start = time.perf_counter()
        main_text("<p>" + part * n + "text")
        return time.perf_counter() - start

    for part in ("<b>", '<a href="x', "<a href='", "<!--x", "<svg>", "</i>", "<li><b>", "<", "<textarea"):
        assert seconds(part, 40_000) < 12 * max(seconds(part, 5_000), 0.02), part


def test_density_alone_finds_the_articles():
    """Without the tags and names that say what is what."""
    pages = pq.read_table(f"{SF}/pages.parquet").to_pylist()
    marks = re.compile(r"<(/?)(?:article|nav|aside|footer|header|main)[^>]*>")
    named = re.compile(r' class="[^"]*"')
    same = sum(
        main_text(named.sub("", marks.sub(r"<\1div>", page["html"]))) == main_text(page["html"])
        for page in pages
    )
    assert same >= 0.9 * len(pages)
