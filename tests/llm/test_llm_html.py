"""Main text of pages: made pages, damaged pages, the given pages against a plain cut."""

import html
import re

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from wayfare.llm.html_text import extract, main_text

BODY = "This is a paragraph of the article, with commas, and enough words to count."

PAGES = [
    (None, ""),
    ("", ""),
    ("plain text &amp; more", "plain text & more"),
    ("<p>a<p>b &lt;c&gt; &eacute;&#233;&#xe9;", "a b <c> ééé"),
    ("<html><body></body></html>", ""),
    ("<", "<"),
    ("<script>only()</script>", ""),
    (
        f'<header><a href="/">Site</a></header><nav><li>x</li></nav><main><header><h1>Title</h1></header><p>{BODY}</p>'
        f"<aside>side</aside></main><footer>foot</footer>",
        f"Title {BODY}",
    ),
    (
        f'<div id="menu"><a href="/a">Home</a></div><div class="content"><h2>T</h2><p>{BODY}</p><p>Short.</p>'
        f'<div class="comments"><p>{BODY}</p></div></div><div id="footer">x</div>',
        f"T {BODY} Short.",
    ),
    (
        f'<article><p>{BODY}<br>next<p><b>bold<i>er</b> end</article><div class="cookie-notice">{BODY}</div>',
        f"{BODY} next bolder end",
    ),
    (f'<div class="wrap has-sidebar"><div class="sideBar">{BODY}</div><article><p>x</article></div>', "x"),
    (f"<body><table><tr><td>{BODY}<td>{BODY}</table>", f"{BODY} {BODY}"),
    (f"<article>{BODY}<form><input value=1>name<button>go</button></form><style>p{{}}</style></article>", BODY),
    (f'<article><p>{BODY}</p><div hidden>no</div><p style="display: none">no</p></article>', BODY),
    (f"<article><ul><li>one<li>two</ul><p>{BODY}</p><!-- <p>no</p> --></article>", f"one two {BODY}"),
    ("<div>" * 20000 + BODY + "</div>" * 20000, BODY),
    (f"<p>{BODY} <a href=x>{'link ' * 5}</a></p><ul>" + "<li><a href=y>menu entry, here</a>" * 30 + "</ul>", f"{BODY} link link link link link"),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_made_pages(page, text):
    assert main_text(page) == text


def test_article_of_the_given_pages(sf_dir):
    pages = pd.read_parquet(f"{sf_dir}/pages.parquet")
    for page in pages.html:
        inside = re.search(r"<article>(.*)</article>", page, re.S).group(1)
        plain = re.sub(r"</?b>", "", re.sub(r"<br>|</?(?:p|h1)>", " ", inside))
        assert main_text(page) == " ".join(html.unescape(plain).split())


TAGS = st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<a href='x'>", "</a>", "<article>", "</article>", "<b", ">", "<!--", "-->", "<script>", "</script>", "&amp;", "&#0;", "text, text", "<td>", "</li>", '<p class="ad', "<br/>"])


@settings(max_examples=300, deadline=None)
@given(st.lists(TAGS, max_size=40))
def test_never_fails(parts):
    text = main_text("".join(parts))
    assert text == " ".join(text.split())


def test_table(spark):
    schema = "page_id long, url string, html string, text string, page string"
    data = [(k, None, page, "clash", "clash") for k, (page, _) in enumerate(PAGES)] * 2
    got = extract(spark.createDataFrame(data, schema)).collect()
    assert sorted((r.row.page_id, r.text) for r in got) == sorted((k, t) for k, (_, t) in enumerate(PAGES) for _ in (0, 1))
    assert all(r.row.text == "clash" for r in got)
    assert extract(spark.createDataFrame([], schema)).collect() == []
