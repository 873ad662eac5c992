from __future__ import annotations

import html
import re

import pytest

from tallybook.llm import template
from tallybook.llm.markup import parsed
from tallybook.llm.queries import QUERIES
from tallybook.llm.template import main_text


def texts(page: str) -> list[str]:
    return [b.text for b in parsed(page, lambda names: "ad" in names).blocks]


@pytest.mark.parametrize(
    "page, expected",
    [
        ("", []),
        ("plain  text\n only", ["plain text only"]),
        ("<p>a<p>b<br>c</p>d", ["a", "b", "c", "d"]),
        ("<p><b>one<br><p>two", ["one", "two"]),
        ("<p>a <b>b</b>c&amp;d &eacute; &#x1F642;</p>", ["a bc&d é 🙂"]),
        ("<script>var x='</p>';</script><style>p{}</style>t<!-- <p>no</p> -->u", ["tu"]),
        ("<p>a <a class='x' href='/'>b</a> <span id=y>c</span>d</p>", ["a b cd"]),
        ("<p>a<span class='top-ad'>b</span>c</p>", ["a", "b", "c"]),
        ("a < b and c > d", ["a < b and c > d"]),
        ("<p title='a > b'>x</p>", ["x"]),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", ["a", "b", "c"]),
        ("<p>unclosed <i>tag", ["unclosed tag"]),
        ("<div>a</span></div></div>b", ["a", "b"]),
        ("x<script>never closed", ["x"]),
        ("<p>cut off &am", ["cut off &am"]),
        ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
    ],
)
def test_blocks(page, expected):
    assert texts(page) == expected


PAGE = """<!DOCTYPE html><html><head><title>T</title></head><body>
<header class="site"><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site to do many things.</div>
<main><article><header><h1>Heading {n}</h1><span class="x">by someone</span></header>
<p>First paragraph number {n} with some   words.</p><div class="ad">Buy now and save a lot of money.</div>
<ul><li>point {n}</li></ul><p>Second &amp; last.</p><form><label>Mail</label><input></form>
<section class="comments"><article><p>I am a reader and this is my comment.</p></article></section>
<footer>Written on a day.</footer></article></main>
<aside>Read this as well, it is about something else.</aside><footer>&copy; us</footer></body></html>"""


def test_article_without_its_surroundings():
    assert main_text(PAGE.format(n=7)) == "Heading 7\nFirst paragraph number 7 with some words.\npoint 7\nSecond & last."


def test_frames_and_heads_of_an_article():
    page = """<body class="has-sidebar"><div class="page with-sidebar"><div class="sidebar"><article><p>Aside</p></article></div>
    <article class="post"><div class="post-header"><h1>Title</h1><p>Posted today</p></div><p>Text with <em class="q">words</em>.</p>
    <ol class="commentList"><li>Well said!</li></ol><span class="adBox">Buy</span><p class="share-links">Share this</p><table><tr><td>1</td></tr></table></article></div>"""
    assert main_text(page) == "Title\nText with words.\n1"


BARE = """<html><body><div class="top"><a href="/">Home page of this web site</a></div>
<div class="c1"><div class="c2"><h2>Story {n}</h2><p>It was day {n} and many things went on in the city, of which this story tells.</p>
<p>Nobody knew {n} of them, or so it is said by all.</p></div></div>
<div class="c3">All the stories of this site are our own work.</div></body></html>"""


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_template_of_a_host_without_article(spark):
    pages = pages_of(spark, [(k, f"http://plain.example.org/{k}", BARE.format(n=k)) for k in range(8)])
    (row,) = template.templates(pages).collect()
    assert row.host == "plain.example.org" and len(row.fixed) == 2
    found = {r.page_id: r.text for r in template.extract(pages).collect()}
    assert found == {
        k: f"Story {k}\nIt was day {k} and many things went on in the city, of which this story tells.\nNobody knew {k} of them, or so it is said by all."
        for k in range(8)
    }


def test_copies_of_a_page_keep_their_article(spark):
    """All text of a host's equal pages has one occurrence vector, but an article's paragraphs stay."""
    pages = pages_of(spark, [(k, "http://copies.example.org/", PAGE.format(n=1)) for k in range(9)])
    assert {r.text for r in template.extract(pages).collect()} == {main_text(PAGE.format(n=1))}


def test_classes_that_do_not_nest_are_no_slots(spark):
    """Class 3 has elements in slots of classes 1 and 2; class 4 has an element inside its own."""
    classes = {"html": 1, "html>body": 1, "html>body>a": 2, "html>body>a>x": 3, "html>body>x": 3, "html>body>a>y": 4, "html>body>a>y>z": 4}
    rows = [("h", hash(path), hash(path.rpartition(">")[0]), 1, number) for path, number in classes.items()]
    elements = spark.createDataFrame(rows, "host string, token bigint, parent bigint, prose bigint, class bigint")
    assert {r["class"] for r in template._nested(elements).collect()} == {1, 2, 4}


def test_elements_are_counted_by_their_tags():
    page = parsed("<div><p>a<br>b</p><p>c <b>d</b></p></div><div>e</div>")
    assert [tuple(map(page.path, b.begun)) for b in page.blocks] == [("div", "div>p"), (), ("div>p",), ("div",)]


NAMED = """<body><div class="story"><div class="c7">{a}</div></div><div class="bar">All the stories of this site are our own.</div></body>"""


def test_text_comes_from_the_slots(spark):
    """An article that only one page names is no slot of the host; the slot named story is."""
    rows = [(k, f"http://slots.example.org/{k}", NAMED.format(a=f"<p>Words number {k} of the story</p>")) for k in range(6)]
    odd = NAMED.format(a="<p>Words of the odd page</p><article><p>Inner words of the page</p></article>")
    found = {r.page_id: r.text for r in template.extract(pages_of(spark, [*rows, (9, "http://slots.example.org/9", odd)])).collect()}
    assert found == {k: f"Words number {k} of the story" for k in range(6)} | {9: "Words of the odd page\nInner words of the page"}


PARTS = """<html><body><div class="top">All the pages of this web site</div><div id="box"><div class="lead"><p>The lead {n} has some words here.</p></div>
<div class="rest"><p>And the rest {n} of it has quite a few more words than that, as the story goes on for a good while and ends with a sentence of great length.</p><p>Yes {n}.</p></div></div></body></html>"""
OTHER = """<html><body><div class="top">All the pages of this web site</div><div class="other"><p>Another layout {n} with words of its own.</p></div></body></html>"""


def test_all_slots_with_prose_are_taken(spark):
    lead = "The lead {0} has some words here.\nAnd the rest {0} of it has quite a few more words than that, as the story goes on for a good while and ends with a sentence of great length.\nYes {0}."
    rows = [(k, f"http://parts.example.org/{k}", PARTS.format(n=k)) for k in range(9)]
    assert {r.page_id: r.text for r in template.extract(pages_of(spark, rows)).collect()} == {k: lead.format(k) for k in range(9)}
    rows += [(k, f"http://parts.example.org/{k}", OTHER.format(n=k)) for k in range(20, 24)]
    found = {r.page_id: r.text for r in template.extract(pages_of(spark, rows)).collect()}
    expected = {k: lead.format(k) for k in range(9)} | {k: f"Another layout {k} with words of its own." for k in range(20, 24)}
    assert found == expected


def test_copies_without_a_named_article(spark):
    page = PARTS.format(n=1)
    expected = "The lead 1 has some words here.\nAnd the rest 1 of it has quite a few more words than that, as the story goes on for a good while and ends with a sentence of great length.\nYes 1."
    copies = [(k, f"http://same.example.org/{k}", page) for k in range(4)]
    assert all(expected in r.text for r in template.extract(pages_of(spark, copies)).collect())
    # Near copies: all prose is shared by pages that differ.
    near = [(k, f"http://near.example.org/{k}", page.replace("Yes 1.", f"Yes {k}.")) for k in range(4)]
    found = {r.page_id: r.text for r in template.extract(pages_of(spark, near)).collect()}
    assert all(expected.replace("Yes 1.", f"Yes {k}.") in found[k] for k in range(4))


def test_a_form_around_the_page(spark):
    rows = [(k, f"http://form.example.org/{k}", PARTS.format(n=k).replace("<body>", "<body><form id=f>").replace("</body>", "</form></body>")) for k in range(5)]
    assert all(r.text.startswith(f"The lead {r.page_id} ") and r.text.endswith(f"Yes {r.page_id}.") for r in template.extract(pages_of(spark, rows)).collect())


def test_query_against_a_plain_reading(spark, medium):
    """These pages have no more than a heading, paragraphs and line breaks in the article."""
    rows = QUERIES["op1_template"](spark, medium).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{medium}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        inside = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id].html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", inside))
        assert r.text == "\n".join(x for x in parts if x) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


RENAMED = {"article": "c3", "nav": "c1", "footer": "c4"}


def renamed(page: str) -> str:
    """The page with neutral elements for those whose names tell what they are."""
    for tag, name in RENAMED.items():
        page = page.replace(f"<{tag}>", f'<div class="{name}">').replace(f"</{tag}>", "</div>")
    return page.replace('<div class="ad">', '<div class="c2">')


def test_pages_without_telling_names(spark, large):
    """The article comes from the slots; without a template the names would be needed."""
    pages = spark.read.parquet(f"{large}/pages.parquet").select("page_id", "url", "html")
    named = {r.page_id: r.text for r in template.extract(pages).collect()}
    rows = [(r.page_id, r.url, renamed(r.html)) for r in pages.collect()]
    neutral = spark.createDataFrame(rows, pages.schema).repartition(8)
    found = {r.page_id: r.text for r in template.extract(neutral).collect()}
    assert len(found) == len(named) == 2500
    right = sum(found[k] == named[k] for k in named)
    assert right >= 0.95 * len(named), right
    alone = sum(main_text(html) == named[k] for k, _, html in rows)
    assert alone < 0.05 * len(named)


def test_the_host_tells_where_a_short_article_is(spark):
    """On one page the text beside the article is longer than the article."""
    long = "This is a sentence of the article with number {n}, and there are more of its kind. " * 6
    frame = '<body><div class="a"><p>{article}</p></div><div class="b">Buy thing {n} today, it is cheap and it lasts for ever</div></body>'
    rows = [(k, f"http://short.example.org/{k}", frame.format(article=long.format(n=k), n=k)) for k in range(8)]
    rows.append((9, "http://short.example.org/9", frame.format(article="Only a few words here.", n=9)))
    found = {r.page_id: r.text for r in template.extract(pages_of(spark, rows)).collect()}
    assert found[9] == "Only a few words here." and found[3] == long.format(n=3).strip()
    assert main_text(rows[-1][2]) != found[9]


@pytest.mark.parametrize("unit", ["<div>", "<div>x", "<b>", "<div><p>a b c d e f", "<b><p></p>", "</i></section>", "<ul><li>"])
def test_deeply_nested_and_stray_tags(unit):
    import time
    import tracemalloc

    page = "<i>" + unit * (50_000 // unit.count("<")) + "the end of all of this"
    started = time.perf_counter()
    text = main_text(page)
    assert time.perf_counter() - started < 6 and text.endswith("the end of all of this")
    tracemalloc.start()
    main_text(page)
    assert tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()


def test_edge_cases(spark):
    rows = [(None, None, None), (1, "http://a.example/", ""), (1, "http://a.example/", ""), (2, "no url", "<p>x</p>"), (3, None, PAGE.format(n=3))]
    rows += [(4, "http://a.example/", "<p>" + "long text " * 200_000), (5, "http://a.example/", "<<<>>>&&&")]
    pages = spark.createDataFrame([(*r, "h", "r", 1) for r in rows], "page_id bigint, url string, html string, host string, root string, fixed int")
    found = template.extract(pages).collect()
    assert sorted((r.page_id or 0, len(r.text)) for r in found) == [
        (0, 0), (1, 0), (1, 0), (2, 1), (3, len(main_text(PAGE.format(n=3)))), (4, 1_999_999), (5, 9)
    ]
    assert template.extract(pages.limit(0)).count() == 0
