"""Main-text extraction on real-looking pages."""

import html
import random
import re

import pytest

from ingot.llm import html_extract as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><p>not text";</script></head><body class="has-sidebar">
<header><a href=/>Site name</a></header><nav><ul><li><a>Home</a><li><a>More</a></ul></nav><!-- <p>comment</p> -->
<div class="cookie-notice">We use cookies, a long notice that goes on and on for quite a while and says nothing at all.</div>
{body}
<aside>Side text that is rather long too, with many words to make it look like the real thing, but it is not.</aside>
<div id="comments"><article class="comment"><p>A reader comment of some length that is certainly no part of the article text.</p></article></div>
<form><label>Your mail</label><input><textarea>x</textarea></form><footer>&copy; footer</footer></body></html>"""
WANT = "The title & more\nFirst paragraph with bold and link text, which is long enough to count as content here.\nShort.\nA list item\nAnother one\nLast paragraph 1 < 2, again with a reasonable number of words in it."
BODY = """<h1>The title &amp; more</h1><p>First   paragraph\n with <b>bold</b> and <a href="x">link</a> text, which is long enough to count as content here.<br>
<p>Short.<ul><li>A list item<li>Another one</ul><div class="ad">Buy this now!</div><p>Last paragraph 1 &lt; 2, again with a reasonable&nbsp;number of words in it.</p>"""


@pytest.mark.parametrize("around", ["<article>{}</article>", "<main>{}</main>", "<div role='main'>{}</div>", "<div id='post-body'>{}</div>", "<section>{}</section>"])
def test_article_in_any_container(around):
    assert H.main_text(PAGE.format(body=around.format(BODY))) == WANT


def test_page_cut_off_and_unclosed_elements():
    assert H.main_text("<body><nav>menu</nav><article><h1>T</h1><p><b>" + "word " * 50 + "<p>tail of it") == "T\n" + ("word " * 50).strip() + "\ntail of it"


@pytest.mark.parametrize("page", [None, "", " ", "<html></html>", "<script>x", "<nav>only a menu</nav>", "<"])
def test_pages_without_text(page):
    assert H.main_text(page) in ("", "<")


def test_very_long_page_and_deep_nesting():
    assert H.main_text("<article>" + "<p>some words</p>" * 30_000).count("\n") == 29_999
    H.main_text("<div>" * 20_000 + "deep" + "</div>" * 20_000)


def test_any_markup_is_read():
    r = random.Random(1)
    pieces = ["<p>", "</p>", "<div class='ad'>", "</div>", "<article>", "</article>", "text ", "<!--", "-->", "<![CDATA[", "]]>", "<![if x]>", "<!DOCTYPE", "&amp;", "&#x;", "<", "<a href='x", "'>", "<script>", "</script>", "<br/>", "\x00", "<?php ", "</"]
    for _ in range(2000):
        H.main_text("".join(r.choice(pieces) for _ in range(r.randrange(25))))


def test_smoothing_and_threshold():
    import numpy as np

    v = H.smoothed(np.array([1.0, 1, 1, 90, 2, 80, 1, 1, 1]))
    assert (v >= H.threshold(v)).tolist() == [False, False, True, True, True, True, True, False, False]
    assert H.threshold(np.array([5.0, 5.0])) <= 5.0


def test_query_on_the_table(spark):
    from ingot.llm.queries import QUERIES

    d = "/root/testdata/sf0.001"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    got = QUERIES["op2_html_extraction"](spark, d).collect()
    assert len(got) == len(pages)
    for r in got:  # the test pages mark their article
        blocks = re.split(r"</?(?:p|h1)>", re.search("<article>(.*?)</article>", pages[r["page_id"]], re.S)[1])
        want = "\n".join(t for b in blocks if (t := " ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split())))
        assert r["text"] == want and r["n_chars"] == len(want)


def test_nulls_repeats_extra_columns_and_no_rows(spark):
    rows = [(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "<p>a &eacute;</p>", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert sorted(map(tuple, H.extract(pages).collect()), key=str) == sorted([(1, "u", "", 0), (1, "u", "", 0), (None, None, "a é", 3)], key=str)
    assert H.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("around", [
    '<div class="content has-sidebar"><article>{}</article></div>', '<div class="content has-sidebar">{}</div>', '<article class="post category-legal">{}</article>',
    '<article class="tag-search">{}</article>', '<article class="post comments-open">{}</article>', '<article class="post legal">{}</article>', '<div class="sidebar"><main>{}</main></div>',
    '<form id="aspnetForm" action="/"><input type="hidden"><div><article>{}</article></div><button>Send</button></form>', '<form><div>{}</div><select><option>a</select></form>',
])
@pytest.mark.parametrize("stray", ["", "<p>1 May</p>"])
def test_wrappers_named_like_boilerplate(around, stray):
    page = around.format(BODY)
    assert H.main_text(f"<body>{stray}{page}") in (WANT, f"1 May\n{WANT}")
    assert H.main_text(PAGE.format(body=page)) == WANT


def test_comments_longer_than_the_article():
    comment = "<article class='comment'><p>" + "reader comment " * 60 + "</p></article>"
    for talk in (f"<div id='comments'>{comment * 3}</div>", f"<div class='comments-area'>{comment * 3}</div>", comment * 3, f"<div id='comments'>{comment.replace('article', 'div') * 3}</div>"):
        assert H.main_text(f"<body><article>{BODY}</article>{talk}") == WANT


PARAGRAPHS = ["The first paragraph of the text has a good number of words and goes on for a while, as they do.", "Short one.", "A second long paragraph follows here, and it also holds <a href=x>a link</a> among many other words.",
              "The third one is as long as the others are, with words upon words, until it has been long enough."]
TEXT = "\n".join(re.sub("<[^>]*>", "", p) for p in PARAGRAPHS)
MENU = "".join(f"<a href=/{x}>{x}</a> " for x in ("Home", "News", "Sports", "About us", "Contact"))
MENU_LIST = "<ul>" + "".join(f"<li><a href=/{x}>{x}</a></li>" for x in ("Home", "News", "Sports", "About us", "Contact")) + "</ul>"
FLOW = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)


@pytest.mark.parametrize("menu", [f"<div>{MENU}</div>", MENU_LIST, f"<div>{MENU_LIST}</div>"])
@pytest.mark.parametrize("footer", ["<div>(c) 2024 Example</div>", f"<div>{MENU} (c) 2024</div>", f"<div><div>{MENU}</div><div>All rights reserved</div></div>", ""])
def test_pages_without_names_lose_menus_and_footers(menu, footer):
    assert H.main_text(f"<html><body>{menu}{FLOW}{footer}</body></html>") == TEXT
    assert H.main_text(f"<html><body>{menu}<div>{FLOW}</div>{footer}</body></html>") == TEXT


@pytest.mark.parametrize("inside", [MENU_LIST, f"<div>{MENU}</div>", f"<section>{MENU_LIST}</section>"])
def test_menus_and_link_lists_inside_articles(inside):
    assert H.main_text(f"<article>{inside}{FLOW}</article>") == TEXT
    assert H.main_text(f"<article>{FLOW}{inside}</article>") == TEXT
    half = "".join(f"<p>{p}</p>" for p in PARAGRAPHS[:2]) + inside + "".join(f"<p>{p}</p>" for p in PARAGRAPHS[2:])
    assert H.main_text(f"<article>{half}</article>") == TEXT


def test_what_is_short_but_of_the_article_stays():
    items = "<ul><li>One item</li><li>Another item</li></ul>"
    want = TEXT + "\nOne item\nAnother item"
    assert H.main_text(f"<article>{FLOW}{items}</article>") == want and H.main_text(f"<body>{FLOW}{items}</body>") == want
    divs = "".join(f"<div>{p}</div>" for p in [*PARAGRAPHS, "Yes."])
    assert H.main_text(f"<body>{divs}</body>") == TEXT + "\nYes." == H.main_text(f"<article>{divs}</article>")
    assert H.main_text(f"<body><div><h1>The headline</h1></div>{FLOW}</body>") == "The headline\n" + TEXT
    assert H.main_text(f"<article><header><h1>The headline</h1><p>1 May</p></header>{FLOW}</article>") == "The headline\n" + TEXT
    assert H.main_text(f"<body><header><h1>Site</h1></header><article>{FLOW}</article></body>") == TEXT
    assert H.main_text(f"<article><a href=x>{FLOW}</article>") == TEXT  # a link never closed
