import html
import re

import pytest
from helpers import SF0001, collected
from pyspark.sql import functions as F

from tidewatch.llm import page_text, queries
from tidewatch.llm.page_text import Page

SF001 = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string"


def plain(source):
    """The article of the tables' pages by patterns: other parts stand outside of it there."""
    article = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", source, re.S)
    text = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br)>", " ", article[1] if article else ""))
    return " ".join(html.unescape(text).split())


def text(source):
    return Page(source).prepared().text()


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("host", "key", "page", "file", "text", "n", "n_chars"):
        df = df.withColumn(c, F.lit("clash"))
    got = collected(page_text.extract(df, **kw))
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    return got


@pytest.mark.parametrize("sf", [SF0001, SF001])
def test_whole_tables(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = queries.op11_page_text(spark, sf)
    assert got.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    expected = sorted((r["page_id"], r["url"], plain(r["html"]), len(plain(r["html"]))) for r in pages.collect())
    assert sorted(map(tuple, got.collect())) == expected


@pytest.mark.parametrize("source, expected", [
    ("", ""), ("just text", "just text"), ("a < b &amp; c &lt; d &#233;&#x41; &copy &nosuch; &am", "a < b & c < d éA © &nosuch; &am"),
    ("<p>one<p>two</p>three", "one two three"), ("<p>a<b>b</b>c <i>d</i>\n\t e&nbsp;f</p>", "abc d e f"),
    ("<p><b>open<br><p>next</p>", "open next"), ("<ul><li>a<li>b</ul><dl><dt>t<dd>d</dl>", "a b t d"),
    ("<table><tr><td>1<td>2<tr><td>3</table>after", "1 2 3 after"), ("x<!-- <p>no</p> -->y<!-->z<!-- no end <p>w", "xyz"),
    ("<script>var t='</p><p>no';</script>yes<style>p{}</style>", "yes"), ("a<script>no end <p>b", "a"), ("</p></div>a</b></article>b", "ab"),
    ("<title>t</title><body><p>x", "x"), ("<head><title>t<p>u</title><body>x", "x"), ("a<foo bar='>' baz=\"x>y\">b</foo>c", "abc"),
    ("<a title=it's>x</a><a title='y>z'>w</a>", "xw"), ("a<br/>b<hr>c<img src=x>d", "a b cd"), ("a</br>b", "a b"), ("<p>a</ p>b<?php x ?>c", "abc"),
    ("<nav>n</nav><article><h1>H</h1><p>x</p></article><footer>f", "H x"), ("<body>a<main>b<nav>n</nav></main>c", "b"), ("<p>a<article", "a"),
    ("<article>a<form>f<button>b</button></form><aside>s</aside><div class='share social'>t</div>b</article>", "a b"),
    ("<article><header><h1>T</h1>by me<nav><h2>n</h2></nav></header>x<h2 class=share>s</h2><footer>z</footer></article>", "T x"),
    ("<article>a</article><section id='comments'><article class='comment'>c</article></section>", "a"),
    ("<div class='with-comments'><article>a</article></div>", "a"), ("<article>a<div id=comments><p>c</div></article>", "a"),
    ("<div class='page no-sidebar'><article>a</article></div><div class=sidebar><article>t</article></div>", "a"),
    ("<div class=cookie-notice>c</div><div class='ad'>d</div><div role=navigation>m</div><div hidden>h</div><p>x</p>", "x"),
    ("<div class='header'>h</div><article>a</article>", "a"), ("<div class=adage>kept</div><p class='loading'>too", "kept too"),
    ("<ARTICLE CLASS=x><P>A</P></ARTICLE>", "A"), ("<article>a</article>b<article>c</article>", "a c"), ("<article> \n </article>x", ""),
    ("<select><option>a<option>b</select><textarea><p>t</textarea>x", "x"), ("<article><p>a<div>b<p>c</div>d</article>", "a b c d"),
])
def test_one_page(source, expected):
    assert text(source) == expected


def test_deep_and_long_pages():
    deep = "<div>" * 30_000 + "x" + "</div>" * 30_000
    page = Page(deep).prepared()
    assert page.text() == "x" and len(page.subtrees()) == 30_000
    assert text("<b>" * 20_000 + "y" + "<p>" * 20_000 + "z") == "y z"
    assert len(text("<p>" + "word &amp; " * 200_000)) == 200_000 * 7 - 1
    assert text('<a x="' * 3_000) == "" and text("<!-" * 50_000) == ""


def site(n, body, host="a.net", first=0):
    return [(first + i, f"http://{host}/{i}", body(i)) for i in range(n)]


def test_templates_of_a_site_go(spark):
    """Subtrees that no tag or name gives away go by their count on the host, and only there."""
    body = lambda i: f"<div><div>Top of <b>the site</b></div><div><p>Own text {i}</p><p>Licence</p></div><p>Visit us</p></div>"
    rows = site(5, body) + site(2, body, "b.net", 100) + [(200, "http://A.net/x", "<p>Visit us</p><p>Licence, too</p>")]
    got = {r["page_id"]: r["text"] for r in run(spark, rows)}
    assert all(got[i] == f"Own text {i}" for i in range(5))
    assert all(got[100 + i] == f"Top of the site Own text {i} Licence Visit us" for i in range(2))
    assert got[200] == "Licence, too"
    assert {r["text"] for r in run(spark, rows, min_pages=6) if r["page_id"] < 5} == {f"Top of the site Own text {i} Licence" for i in range(5)}


def test_copies_of_a_page_are_no_template(spark):
    rows = site(6, lambda i: "<article><h1>T</h1><div><p>All of it</p></div></article>") + site(6, lambda i: "<div><p>Else</p></div>", "b.net", 10)
    got = {r["page_id"]: r["text"] for r in run(spark, rows)}
    assert all(got[i] == "T All of it" and got[10 + i] == "Else" for i in range(6))


def test_prose_of_articles_stays_and_their_templates_go(spark):
    body = lambda i: f"<article><p>Quoted <i>often</i></p><p>Own {i}</p><ul><li>x</ul><div><p>Read more of us</p></div></article><p>Site</p>"
    assert [r["text"] for r in run(spark, site(4, body))] == [f"Quoted often Own {i} x" for i in range(4)]


def test_awkward_rows(spark):
    rows = [(1, None, None), (2, "", ""), (None, "no scheme", "<p>a"), (4, "http://a.net/", None), (5, None, "<p>b")] + [(6, "http://a.net/", "<p>c")] * 3
    got = sorted(((r["page_id"], r["url"], r["text"]) for r in run(spark, rows)), key=str)
    assert got == sorted(((i, u, {"<p>a": "a", "<p>b": "b", "<p>c": "c"}.get(h, "")) for i, u, h in rows), key=str)
    empty = spark.createDataFrame([], SCHEMA)
    assert page_text.extract(empty).collect() == []


def test_template_files(spark, tmp_path):
    """Many files, few of them mapped at a time, and none is missed."""
    import numpy as np

    from tidewatch.llm import shared_files

    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**64, 5000, dtype=np.uint64))
    of = page_text._file_of(keys, 100)
    for i in range(100):
        shared_files.put(str(tmp_path), f"templates-{i}", keys[of == i])
    known = page_text.Templates(str(tmp_path), 100)
    others = {int(k) for k in rng.integers(0, 2**64, 500, dtype=np.uint64)} - set(keys.tolist())
    asked = set(keys[::7].tolist())
    assert known.among(asked | others) == asked and len(known.mapped) <= page_text.MAPPED
    assert page_text.Templates(str(tmp_path), 0).among(asked) == set()
