"""Main text of pages."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from postpulse.llm import main_text
from postpulse.llm.queries import QUERIES

PAGES = {
    "": "",
    "plain words": "plain words",
    "<p>a<p>b": "a\nb",
    "<p>a &amp; b&nbsp;&lt;c&gt; &copy x &#65;&#x42; &unknown; AT&T</p>": "a & b <c> © x AB &unknown; AT&T",
    "<p>one<br>two <b>th</b>ree</p>": "one two three",
    "<div>a<p>b</p>c</div>": "a\nb\nc",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>": "a\nb\nc\nd",
    "<table><tr><td>a<td>b<tr><td>c</table>d": "a\nb\nc\nd",
    "<dl><dt>a<dd>b<dt>c</dl>": "a\nb\nc",
    "<h1>a<h2>b</h1>c": "a\nb\nc",
    "a<!-- <p>no</p> -->b<!-->c<!--->d": "abcd",
    "a<script>if (x < '<p>') track('</p>')</script>b<style>p{}</style>": "ab",
    "<title>no</title><textarea>no</textarea><p>yes": "yes",
    "<nav>no<ul><li>no</nav><p>yes</p><footer>no</footer><aside>no</aside><form>no<p>no</form>": "yes",
    "<header>no</header><article><header><h1>Title</h1></header>text<footer>no</footer></article>": "Title\ntext",
    "<p>x</p><article><p>a</p></article><p>y</p><article>b</article>": "a\nb",
    "<p>x</p><main><p>a</p></main><article> </article>": "a",
    "<article><p>a<article class='comment'>no</article></article>": "a",
    "<article>a<div id='comments'>no <b>no</b></div>b<div class='CookieNotice'>no</div></article>": "a\nb",
    "<article>a <span class=ad>no</span> b <button>no</button> c</article>": "a b c",
    "<article><select><option>no<option>no</select>yes</article>": "yes",
    "<article><a class=share>no<p>no</a>yes</article>": "yes",
    "<body class='has-sidebar no-comments'><div class='entry-header'>a</div><div class=header>no</div>b": "a\nb",
    "<form><article>a</article></form>": "a",
    "<div class=menu-page><main>a</main></div>": "a",
    "<p hidden>no</p><p style='display: none'>no</p><p aria-hidden=true>no</p><div role=navigation>no</div>a": "a",
    "<p title='a > b' class=\"x\">t</p>": "t",
    "<p title=it's>t</p> it's": "t\nit's",
    "<p class=\"open>a</p><p>b</p>": "a\nb",
    "a < b <3 </ c> d </>e": "a < b <3 d e",
    "a<!doctype html><?xml x?>b": "ab",
    "a<b": "a",
    "a<!-- never closed <p>b": "a",
    "<p>a</div></section></b>b</p>": "ab",
    "a b \n\tc": "a b c",
    "<P>A</P><NAV>no</NAV><SCRIPT>no</SCRIPT >b": "A\nb",
}


@pytest.mark.parametrize("source", list(PAGES))
def test_page(source):
    assert main_text.read_page(source).text() == PAGES[source]
    assert main_text.read_page(source, hashing=True).text() == PAGES[source]


def test_any_markup_is_read():
    rng = random.Random(9)
    bits = ["<p>", "</p>", "<div class=ad>", "</div>", "<b>", "</b>", "<li>", "<ul>", "</ul>", "<td>", "<table>", "</table>", "<!--",
            "-->", "<a href='", "\"", ">", "<", "&amp", "&#x;", "<script>", "</script>", "<article>", "</article>", "x ", "é", "<h2>"]
    for _ in range(3000):
        source = "".join(rng.choices(bits, k=rng.randrange(1, 30)))
        page = main_text.read_page(source, hashing=True)
        assert not page.stack and page.dropped == page.articles == page.mains == 0
        assert page.text() == main_text.read_page(source).text()


@pytest.mark.parametrize("bit", ["<p>word ", "<div>", "<a '", "<a b=\"<i>", "<b>x", "<!--", "&amp;", "</p>", "<li>", "<table><td>", "<", "<p title='\">x"])
def test_long_pages_take_linear_time(bit):
    def seconds(n):
        begun = time.perf_counter()
        main_text.read_page(bit * n, hashing=True)
        return time.perf_counter() - begun

    seconds(1000)
    assert seconds(40_000) < 12 * max(seconds(10_000), 0.02)


def site(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_templates_of_a_host_are_deleted(spark):
    """A repeated box without a telling name goes; the same words on another
    host stay, as do copies of an article and prose that articles share."""
    box = "<div class='x7'><p>Read our rules</p></div>"
    rows = []
    for i in range(10):
        rows.append((i, f"http://A.example/{i}", f"<div>{box}<p>body {i}</p><p>text {i}</p></div>"))
        rows.append((100 + i, "https://b.example/", f"<div>{box if i < 1 else ''}<p>body {i}</p></div>"))
        rows.append((200 + i, "http://copies.example/", "<div><p>same</p><p>article</p></div>"))
        rows.append((300 + i, "http://c.example", f"<article><p>own {i}</p><p>licence</p>{box}</article>"))
        rows.append((400 + i, "no url", f"{box}<p>{i}</p>"))
    found = {r["page_id"]: r["text"] for r in main_text.extract(site(spark, rows).repartition(7)).collect()}
    for i in range(10):
        assert found[i] == f"body {i}\ntext {i}"
        assert found[100 + i] == ("Read our rules\n" if i < 1 else "") + f"body {i}"
        assert found[200 + i] == "same\narticle"
        assert found[300 + i] == f"own {i}\nlicence"
        assert found[400 + i] == f"Read our rules\n{i}"


def test_template_counts_equal_brute_force(spark):
    rng = random.Random(6)
    boxes = [f"<div class=b{k}>box {k} <ul><li>one</li></ul></div>" for k in range(8)]
    rows = []
    for i in range(120):
        host = rng.choice(["a", "a", "b", "c"])
        own = "".join(rng.sample(boxes, rng.randrange(0, 5)))
        rows.append((i, f"http://{host}/", f"{own}<p>text {i % 50}</p>"))
    pages = site(spark, rows)
    host = F.regexp_extract("url", "//(.*)/", 1)
    made = main_text.templates(pages.select(host.alias("_host"), F.col("html").alias("_html")), 0.4, 3)
    found = {r["host"]: set(r["template"]) for r in made.collect()}
    expected = {}
    for name in "abc":
        distinct, on = set(), {}
        for _, url, source in rows:
            if url == f"http://{name}/":
                page = main_text.read_page(source, hashing=True)
                distinct.add(page.text())
                for h in page.hashes:
                    on.setdefault(h, set()).add(page.text())
        expected[name] = {h for h, texts in on.items() if len(texts) >= max(3, 0.4 * len(distinct))}
    assert found == {k: v for k, v in expected.items() if v}


def test_cases(spark):
    rows = [(1, None, "<p>a</p>"), (2, "http://h/", None), (3, "http://h/", ""), (None, "http://h/", "<p>b</p>"), (4, "http://h/", "<p>b</p>"),
            (4, "http://h/", "<p>b</p>"), (5, "http://h/", "<p>" + "w " * 200_000 + "</p>"), (6, "http://h/", "<p>😀 é</p>")]
    table = site(spark, rows)
    for name in ("_host", "_template", "_salt", "host", "template", "subtree", "text", "_html"):
        table = table.withColumn(name, F.lit(f"own {name}"))
    out = main_text.extract(table)
    assert out.columns == [*(c for c in table.columns if c != "text"), "text", "n_chars"]
    found = out.collect()
    assert sorted((r["page_id"] or 0, r["n_chars"], r["text"][:3]) for r in found) == [
        (0, 1, "b"), (1, 1, "a"), (2, 0, ""), (3, 0, ""), (4, 1, "b"), (4, 1, "b"), (5, 399_999, "w w"), (6, 3, "😀 é"),
    ]
    assert all(r["_host"] == "own _host" and r["_template"] == "own _template" and r["subtree"] == "own subtree" for r in found)
    assert main_text.extract(table.limit(0)).count() == 0


def test_query_takes_the_articles(spark, sf_dir):
    """The given pages hold one article each: its blocks, read another way."""
    import html
    import re

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = QUERIES["op13_main_text"](spark, sf_dir)
    assert found.columns == ["page_id", "url", "text", "n_chars"] and dict(found.dtypes)["n_chars"] == "bigint"
    found = found.collect()
    assert len(found) == len(pages)
    for row in found:
        article = re.search(r"<article>(.*)</article>", pages[row["page_id"]], re.S)[1]
        blocks = [html.unescape(re.sub(r"<[^>]*>", " ", x)).split() for x in re.split(r"</?(?:p|h1)>", article)]
        assert row["text"] == "\n".join(" ".join(b) for b in blocks if b) and row["n_chars"] == len(row["text"])
