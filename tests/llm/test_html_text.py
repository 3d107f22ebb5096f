"""HTML extraction: the driver's pages against a plain reading, and hand-made pages."""

import html
import re
import time

import pytest
from pyspark.sql import functions as F

from tarmac.llm import html_text as H
from tarmac.llm.tables import table

from ..conftest import SF_ORACLE


def plain_reading(page):
    """What stands in the page's one article, by cutting the markup out."""
    body = re.search(r"<article>(.*?)(</article>|<footer>|$)", page, re.S)[1]
    blocks = re.split(r"</?(?:h1|p|br)>", body)
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks)
    return " ".join(t for t in texts if t)


def test_query_equals_plain_reading(spark):
    pages = {r.page_id: r.html for r in table(spark, SF_ORACLE, "pages").collect()}
    rows = H.op6_html_extraction(spark, SF_ORACLE).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == plain_reading(pages[r.page_id]), r.page_id
        assert r.n_chars == len(r.text)


PARAGRAPHS = "<p>First, a paragraph of some length, with commas, and words.</p><p>Second one, also long enough, to count &amp; more.</p>"
TEXT = "First, a paragraph of some length, with commas, and words. Second one, also long enough, to count & more."
BESIDE = [
    '<nav><ul><li><a href="/">Home</a></li><li><a href="/x">Other, page</a></li></ul></nav>',
    "<header><h2>Site name, slogan</h2></header>",
    '<div id="sidebar"><p>Side, story, one, two, three, four.</p></div>',
    '<div class="cookie-notice"><p>We use cookies, and so on, and so on.</p></div>',
    '<section class="comments"><article class="comment"><p>Great, really, great, post, thanks, bye.</p></article></section>',
    '<form action="/s"><label>Search, please</label><input name="q"><button>Go</button></form>',
    '<aside><p>Related, things, to, read, here, now.</p></aside>',
    "<script>if (a < b) { document.write('<p>no, no, no</p>') }</script><style>p { color: red }</style>",
    '<ul class="menu"><li><a href="/a">A</a><li><a href="/b">B</a><li><a href="/c">C</a></ul>',
    '<div class="ad"><p>Buy, buy, buy, now, cheap, things.</p></div>',
    "<footer><p>Copyright, all rights, reserved, by us.</p></footer>",
    '<div style="display: none"><p>Hidden, text, of, no, use, here.</p></div>',
    '<div role="banner">Banner, text</div>',
    '<ol class="commentlist"><li>First, comment, of, a, reader.</li></ol><div id="userComments"><p>One, more, comment, here.</p></div>',
    '<div class="site-header"><p>Slogan, of, the, site, again.</p></div><p class="alert">Notice, to, all, readers.</p>',
    "<!-- a comment, <p>with markup</p> -->",
]


@pytest.mark.parametrize("wrap", ["<article>{}</article>", '<div class="content">{}</div>', "<main><div>{}</div></main>", "<div><div>{}</div></div>"])
def test_only_the_article_is_kept(wrap):
    rest = "".join(BESIDE)
    page = f"<html><head><title>T, t</title></head><body>{rest}{wrap.format(PARAGRAPHS)}{rest}</body></html>"
    assert H.main_text(page) == TEXT
    inside = f"<html><body>{wrap.format(PARAGRAPHS.replace('</p><p>', '</p>' + rest.replace(BESIDE[1], '').replace(BESIDE[-2].split('<p class')[0], '') + '<p>'))}</body></html>"
    assert H.main_text(inside) == TEXT


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""),
        ("", ""),
        ("<html></html>", ""),
        ("no markup, just text", "no markup, just text"),
        ("<p>one<p>two <b>bold<br>line<p>three", "one two bold line three"),
        ("<body><div>a<div>b</div>c</div>", "a b c"),
        ("<article><h1>Title</h1><p>in<b>li</b>ne &#233;&nbsp;x &lt;tag&gt;\n  y</p></article>", "Title inline é x <tag> y"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a b c"),
        ("<article><ul><li>item one, text<li>item two</ul></article>", "item one, text item two"),
        ("<form><article><p>Whole page in a form, as some do.</p></article></form>", "Whole page in a form, as some do."),
        ("<article><p>cut off in the mid", "cut off in the mid"),
        ("<article><header><h1>Own title</h1></header><p>Text, text.</p></article>", "Own title Text, text."),
        ("<article><div class='article-header'><h1>Own title</h1></div><p>Text, text.</p></article>", "Own title Text, text."),
        ("<body class='has-sidebar nav'><p>Body text, here.</p>", "Body text, here."),
        ("<article><p>a</p></b></i></div><p>b</p></article>", "a b"),
        ("<article><p>a <![foo[x]]>b <![if !IE]>c<![endif]> <![>d <!-- open</p><p>e", "a b c d e"),
        ("<article><p>one <a href='cut of", "one"),
    ],
)
def test_cases(page, text):
    assert H.main_text(page) == text


def test_siblings_of_the_best_container_are_kept():
    section = "<div><p>{0}, a paragraph, of the story, that is long enough to count as one, surely.</p><p>{0}, more, of it.</p></div>"
    page = f"<body><div>{section.format('One')}{section.format('Two')}{section.format('Three')}</div></body>"
    assert [x for x in ("One", "Two", "Three") if x in H.main_text(page)] == ["One", "Two", "Three"]


def test_deep_and_long_pages():
    deep = "<div>" * 5000 + "deep text, here" + "</div>" * 5000
    assert H.main_text(deep) == "deep text, here"
    long = "<article>" + "<p>word, word.</p>" * 20_000 + "</article>"
    assert H.main_text(long) == " ".join(["word, word."] * 20_000)


def test_frame_keeps_columns(spark):
    frame = spark.createDataFrame([(1, None, "u"), (1, "<p>x</p>", None), (None, "", "u")], "page_id long, html string, url string")
    out = H.add_main_text(frame.withColumns({"text": F.lit("t"), "length": F.lit(1)}), text="main", n_chars="chars")
    assert out.columns == ["page_id", "html", "url", "text", "length", "main", "chars"]
    assert sorted((r.main, r.chars, r.text) for r in out.collect()) == [("", 0, "t"), ("", 0, "t"), ("x", 1, "t")]
    assert H.add_main_text(frame.limit(0)).collect() == []


BODY = "".join(f"<p>Paragraph {i}, {'of words ' * 20}, with commas, here.</p>" for i in range(5))
LINKS = "<ul>" + "".join(f"<li><a href='/{i}'>Source {i} of this</a></li>" for i in range(4)) + "</ul>"


@pytest.mark.parametrize("tag", ["article", "main"])
def test_an_article_around_the_best_container_is_kept_whole(tag):
    rest = "".join(BESIDE)
    page = f"<body>{rest}<{tag}><h1>Title</h1><div class='entry'>{BODY}</div><h2>End</h2><p>Short end.</p><table><tr><td>cell</td></tr></table>{LINKS}<nav>No, no</nav></{tag}>{rest}{LINKS}</body>"
    text = H.main_text(page)
    assert text.startswith("Title Paragraph 0, of words") and "Paragraph 4, " in text
    assert text.endswith("here. End Short end. cell " + " ".join(f"Source {i} of this" for i in range(4)))


def test_headings_beside_the_best_container_are_kept():
    page = f"<body><div>{LINKS}<h1>Title</h1><p>By me</p><div>{BODY}</div><h2>Part two</h2><p>Short.</p><div>{BODY}</div>{LINKS}</div></body>"
    text = H.main_text(page)
    assert text.startswith("Title By me Paragraph 0") and "here. Part two Short. Paragraph 0" in text and "Source" not in text
    page = f"<body><main><h1>Title</h1><article>{BODY}</article></main></body>"
    assert H.main_text(page).startswith("Title Paragraph 0")


@pytest.mark.parametrize("form", ["<form id='aspnetForm' method='post'>{}</form>", "<form><div class='content'>{}</div></form>"])
def test_a_form_around_the_page_is_no_form_beside_it(form):
    rest = "".join(BESIDE)
    text = H.main_text(f"<body>{form.format(rest + '<div>' + BODY + '</div>' + rest)}</body>")
    assert text == " ".join(f"Paragraph {i}, {'of words ' * 20}, with commas, here.".replace("  ", " ") for i in range(5))


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<div class='content'>{}</div>"])
def test_names_are_read_by_their_last_word(wrap):
    share = "<section class='share-prices'><p>The share prices fell, as they had the day before, by a tenth.</p></section>"
    notice = "<p class='notice-period'>The notice period is three months, or more.</p>"
    beside = [
        "<div class='sidebar-left'><p>Side story, of no use here, with some length.</p></div>",
        "<div class='comment-body'><p>A long comment, by a reader, who liked it a lot.</p></div>",
        "<div class='social-media-icons'><a href='/f'>Follow us</a></div>",
        "<div id='ad-container-2'><p>Buy this thing, now, before it is gone, really.</p></div>",
    ]
    text = H.main_text(f"<body>{wrap.format(BODY + share + ''.join(beside) + notice)}</body>")
    assert text.endswith("here. The share prices fell, as they had the day before, by a tenth. The notice period is three months, or more.")


@pytest.mark.parametrize(
    "page,text",
    [
        ("<div>" * 100_000 + "deep text, here" + "</div>" * 100_000, "deep text, here"),
        ("<b>" * 100_000 + "<p>one, two.</p>" * 3, "one, two. one, two. one, two."),
        ("<b>" * 50_000 + "<p>x" * 50_000, " ".join(["x"] * 50_000)),
        ("<div><span>" * 50_000 + "</i>" * 50_000 + "text, here", "text, here"),
        ("<table><tr><td>" * 30_000 + "cell, here" + "</div>" * 30_000, "cell, here"),
        ("<a><p>" * 30_000 + "text, here", None),
        ("text, here" + "<!--" * 100_000, "text, here"),
        ("text, here" + "<!--x>" * 100_000, "text, here"),
        ("text, here" + "<a " * 100_000, "text, here"),
        ("text, here" + "</" * 100_000, "text, here"),
        ("text, here" + "<![" * 100_000, "text, here"),
        ("text, here<p " + "a=b " * 100_000 + ">more", "text, here more"),
        ("text, here" + "<script>" * 100_000, "text, here"),
    ],
)
def test_time_does_not_grow_with_depth(page, text):
    began = time.perf_counter()
    found = H.main_text(page)
    assert text is None or found == text
    assert time.perf_counter() - began < 20
