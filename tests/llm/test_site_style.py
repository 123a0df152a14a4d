import html
import re

import pytest

from corpuslens.llm import site_style
from corpuslens.llm.dom import Page
from corpuslens.llm.queries import QUERIES

SCHEMA = "page_id LONG, url STRING, html STRING, host STRING, cut STRING"


def texts(source):
    return [t for _, t in Page(source).blocks]


@pytest.mark.parametrize("source, blocks", [
    ("", []), ("plain  text\n", ["plain text"]), ("<p>a<p>b", ["a", "b"]), ("<p><b>x<br>y<br><p>z</p>", ["x y", "z"]),
    ("<P CLASS=x>A&amp;B &lt;c&gt; &eacute;&#233;&#x41;</P>", ["A&B <c> éé" + "A"]),
    ("<ul><li>1<li>2<ul><li>3</ul><li>4</ul>5", ["1", "2", "3", "4", "5"]),
    ("<script>var t='</p>';</script >x<style>p{}</style><!-- <p>no</p> -->y", ["xy"]),
    ("a < b and <c", ["a < b and"]), ("<a title='x > y'>link</a> <i>to</i>", ["link to"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]), ("<div>a<span>b</div>c", ["ab", "c"]),
    ("<title>no", []), ("<p>open &amp", ["open &"]), ("</p></div>x</b>", ["x"]), ("<!doctype html><![CDATA[x]]>y", ["y"]),
])
def test_blocks(source, blocks):
    assert texts(source) == blocks


def test_long_and_broken_pages():
    assert len(texts("<p>" + "word " * 400_000)) == 1
    assert len(texts("<div>" * 20_000 + "x")) == 1
    assert len(texts("<p>x" * 30_000)) == 30_000
    assert texts('<a href="' + "<" * 20_000) is not None
    assert len(texts("<" * 50_000)) == 1
    assert site_style.extract("<div>t" * 20_000).count("\n") == 19_999
    assert len(list(site_style.page_nodes("h", "<div>t" * 5_000))) == 10_000


PAGE = """<html><body class="has-sidebar"><header><h2>Site</h2></header><nav><ul><li>Home</li></ul></nav>
<div class="cookie-notice">We use cookies</div><div class="sidebar">Side</div>
<article><h1>Title {i}</h1><p>First &amp; only {i}.</p><div class="ad-box">Buy</div><div class="q7">Share this page with friends</div>
<form>Mail <input></form><p>Second<br>line {i}</p><aside>See also</aside>
<section id="comments"><article><p>I agree</p></article></section></article>
<footer>&copy; host</footer></body></html>"""


def test_article_without_the_rest(spark):
    pages = [(i, f"https://Site.example/{i}?x", PAGE.replace("{i}", f"n{i}"), "h", "c") for i in range(12)]
    pages += [(100, "https://other.example/", PAGE, "h", "c"), (101, None, PAGE, None, None), (102, "https://site.example/", None, "", ""),
              (103, "https://site.example/", "", "", ""), (None, "https://site.example/", "<p>x", "", ""), (3, "https://site.example/", "<p>x", "", "")]
    out = site_style.main_text(spark.createDataFrame(pages, SCHEMA)).collect()
    assert len(out) == len(pages)
    by = {(r.page_id, r.url): r.text for r in out}
    # The site's tree shows that the line without a telling name is the same on all its pages.
    assert by[3, "https://Site.example/3?x"] == "Title n3\nFirst & only n3.\nSecond line n3"
    assert by[100, "https://other.example/"].split("\n") == ["Title {i}", "First & only {i}.", "Share this page with friends", "Second line {i}"]
    assert by[101, None] == by[100, "https://other.example/"]
    assert by[102, "https://site.example/"] == by[103, "https://site.example/"] == ""
    assert by[None, "https://site.example/"] == by[3, "https://site.example/"] == "x"


def test_copied_pages_keep_their_article(spark):
    body = "<article><div class='body'><p>One long text that is the same on every page of the site.</p><p>And more.</p></div></article>"
    pages = [(i, f"http://copy.example/{i}", f"<body>{body}<p class='foot'>{i}</p></body>", "", "") for i in range(20)]
    out = site_style.main_text(spark.createDataFrame(pages, SCHEMA)).collect()
    assert {r.text for r in out} == {"One long text that is the same on every page of the site.\nAnd more."}


def test_importance(spark):
    rows = [("h", f"<nav>menu</nav><div class='x'>text{chr(97 + i)}</div>", "http://h/") for i in range(10)] * 3
    given = spark.createDataFrame(rows, "host STRING, html STRING, url STRING")
    found = sorted((round(r.importance, 6), r.pages) for r in site_style.tree(given).collect())
    assert found == [(0.0, 10), (1.0, 10)]


def test_query_against_a_pattern(spark, sf):
    sources = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    out = QUERIES["op4_site_style_text"](spark, sf).collect()
    assert len(out) == len(sources)
    for r in out:
        article = re.search("<article>(.*)</article>", sources[r.page_id], re.DOTALL)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_empty_table(spark):
    assert site_style.main_text(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("wrapper", ["class='content-sidebar-wrap'", "class='layout has-sidebar'", "class='search widget'", "id='comments'"])
def test_wrapper_does_not_cost_the_article(wrapper):
    article = "<article><h1>Title</h1><p>Text</p></article>"
    assert site_style.extract(f"<body><div {wrapper}>{article}<div class='sidebar'>Side</div></div></body>") == "Title\nText"


def test_only_whole_names_on_the_element_drop_it():
    names = ("post-header", "legal", "register", "menu-item-text", "header", "my_menu", "menu")
    source = "".join(f"<div class='{c}'><h2>{c}</h2></div>" for c in names)
    assert site_style.extract(f"<article>{source}</article>").split() == list(names[:-1])


def test_every_outer_article_stays():
    long = "<article><p>" + "long text " * 50 + "</p></article>"
    assert site_style.extract(f"<main>{long}<article><p>short</p></article><aside><article>no</article></aside></main>").endswith("\nshort")
    both = "<article class='comment'><p>I agree</p></article><article><p>Text</p></article>"
    assert site_style.extract(both) == "Text"
    assert site_style.extract("<article class='widget'><p>Text</p></article>") == "Text"
