import random
import re

import oracle
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from textloom.functions import blocks as B
from textloom.plans.catalog import CATALOG

WORDS = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore. "


def page(body, head="<title>The  title</title>"):
    return f"<!DOCTYPE html><html><head>{head}<style>p{{}}</style><script>var a='</p>';</script></head><body>{body}</body></html>"


NAV = "<nav><ul>" + "".join(f'<li><a href="/{i}">Menu entry {i}</a></li>' for i in range(12)) + "</ul></nav>"
FOOT = "<footer>&copy; all rights " + WORDS + "</footer>"


@pytest.mark.parametrize(
    "body",
    [
        f"{NAV}<article><h1>Head</h1><p>{WORDS * 3}</p><p>{WORDS} one</p></article>{FOOT}",
        f"{NAV}<div class='content'><h1>Head</h1><p>{WORDS * 3}</p><p>{WORDS} one</p></div><div id='side-bar' class='sidebar'><p>{WORDS * 5}</p></div>{FOOT}",
        f"{NAV}<div><div><h1>Head</h1><p>{WORDS * 3}<p>{WORDS} one</div></div><div class='comments'><p>{WORDS * 9}</p></div>{FOOT}",
        f"<div class='ad'>{WORDS}</div><main><h1>Head</h1><p><b>{WORDS * 3}<br></p><p>{WORDS} one</p><ul><li><a href='/'>a link of some length</a></li></ul></main>{FOOT}",
    ],
)
def test_articles_stay_and_what_is_around_goes(body):
    title, text = B._main(page(body))
    assert title == "The title" and text.split("\n") == ["Head", (WORDS * 3).strip(), WORDS + "one"]


def test_short_articles_give_way_to_the_best_container():
    teaser = "<article><p>Read more, now.</p></article>"
    body = f"{NAV}{teaser}<section><p>{WORDS * 2}</p><p>{WORDS * 2}</p></section><section><p>{WORDS * 2}</p><p>{WORDS * 2}</p></section><section><p>No.</p></section>"
    assert B._main(page(body))[1] == "\n".join([(WORDS * 2).strip()] * 4)


def test_links_tables_and_broken_html():
    linked = "<p><a href='/x'>" + WORDS * 3 + "</a></p>"
    title, text = B._main(page(f"<div>{linked}<p>{WORDS * 3}</p><table><tr><td>cell</td></tr></table></div>", head=""))
    assert title == "" and text == (WORDS * 3).strip()
    for broken in ("", "<", "</p></div>", "<p>a<p>b", "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "<b><i>x", "<script>never closed", "<table><tr><td>a<td>b<tr><td>c", "<!-- x", "&amp;&nbsp;&#65;&bogus;", "\0"):
        assert isinstance(B._main(broken)[1], str) and isinstance(B.semantic(broken, 20), list)
    deep = "<div>" * 3000 + "<p>" + WORDS * 4 + "</p>"
    assert B._main(deep)[1] == (WORDS * 4).strip()


def test_document_text_falls_back(spark):
    from textloom.operators import crawl

    pages = spark.createDataFrame([("http://a/", page(f"{NAV}<article><p>{WORDS * 4}</p></article>")), ("http://b/", page("<div><p>Short text</p></div>")), ("http://c/", None)], "url string, html string")
    got = {r.url: (r.title, r.text) for r in crawl.clean(pages, 1).collect()}
    assert got == {"http://a/": ("The title", (WORDS * 4).strip()), "http://b/": ("The  title", "Short text")}
    n = crawl.counters(pages, 100).first()
    assert (n.total, n.kept, n.dropped, n.errors) == (3, 1, 1, 1)


def random_page(rng):
    held, parts = [], []
    for i in range(rng.randint(1, 14)):
        kind = rng.choice(["p", "p", "p", "ul", "table", "pre", "h1", "h2", "code"])
        words = " ".join(f"w{rng.randrange(999)}{rng.choice(['', '.', '!', ','])}" for _ in range(rng.choice([3, 20, 90, 400])))
        if kind == "p":
            parts.append(f"<p>{words}</p>")
        elif kind == "ul":
            items = [f"u{i} {j} {words[:60].strip()}" for j in range(rng.randint(1, 30))]
            held.append("\n".join(f"- {t.strip()}" for t in items))
            parts.append("<ul>" + "".join(f"<li>{t}</li>" for t in items) + "</ul>")
        elif kind == "table":
            rows = [[f"t{i}", str(j), words[:30].strip()] for j in range(rng.randint(1, 30))]
            held.append("\n".join(" | ".join(r) for r in rows))
            parts.append("<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>")
        elif kind == "pre":
            code = "\n".join(f"c{i}  = f({j}); x.y" for j in range(rng.randint(1, 60)))
            held.append(code)
            parts.append(f"<pre><code>{code}</code></pre>")
        elif kind == "code":
            code = f"k{i}.run(a, b) ! " + "z" * rng.choice([1, 40])
            held.append(code)
            parts.append(f"<p>{words} <code>{code}</code> {words}</p>")
        else:
            parts.append(f"<{kind}>H{i}</{kind}>")
    return page("".join(parts)), held


@pytest.mark.parametrize("seed", range(40))
def test_nothing_held_is_cut_and_nothing_is_lost(seed):
    html, held = random_page(random.Random(seed))
    for limit in (80, 1000):
        chunks = B.semantic(html, limit)
        texts = [t for _, _, t in chunks]
        for h in held:
            assert any(h in t for t in texts), h
        for t in texts:
            assert len(t) <= limit or t in held or any(h in t and len(h) > limit - 2 for h in held)
        words = lambda s: re.findall(r"[a-z0-9]+", re.sub("<[^>]*>", " ", s).lower())
        body = re.sub(r"(?s)<h[12]>.*?</h[12]>", " ", html[html.index("<body>") :])
        assert words(" ".join(texts)) == words(body)


def test_sections_headers_and_media(spark):
    html = page("<p>Before</p><h1>One</h1><p>a <img src='x.png'> b</p><h2>Two</h2><video src='v.mp4'></video><p>c</p><h1>Three</h1><ul><li>d<ul><li>e</li></ul></li></ul>")
    want = [("", "", "Before"), ("One", "", "a ![image:x.png](x.png) b"), ("One", "Two", "![video:v.mp4](v.mp4)\n\nc"), ("Three", "", "- d\n- e")]
    got = [(h1, h2, re.sub(" +", " ", t)) for h1, h2, t in B.semantic(html, 1000)]
    assert got == want
    df = spark.createDataFrame([(html,), (None,)], "html string").select(F.size(B.semantic_chunks("html")).alias("n"))
    assert sorted(r.n for r in df.collect()) == [0, 4]


def test_split_text():
    assert B.split_text("a b c", 3, len) == ["a b", "c"]
    assert B.split_text("One. Two! Three?", 6, len) == ["One.", "Two!", "Three?"]
    assert B.split_text("abcdefgh", 3, len) == ["abc", "def", "gh"]
    assert B.split_text("  ", 3, len) == [] and B.split_text("p\n\nq r\ns", 4, len) == ["p", "q r", "s"]


def test_catalog_pages_have_only_their_article(spark, sf):
    got = CATALOG["main_content"].run(spark, sf).collect()
    html = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert len(got) == len(html)
    for r in got:
        foot = re.search(r"<footer>(.*?)</footer>", html[r.page_id], re.S).group(1)
        assert foot.split("&middot;")[-1].strip()[:20] not in r.text or len(r.text) < 200


def test_references_without_their_end_stay_as_in_sql(spark, tmp_path):
    body = f"<article><h1>A&ampB &amp;&amp</h1><p>{WORDS * 3}x&lt y &lt;z&gt; &copy=1 &notit; & &amp;lt; &amp</p></article>"
    rows = [(i, f"http://a.b/{i}", page(b, "<title>T&amp;&amp</title>")) for i, b in enumerate([body, "<p>short &amp &amp;</p>"])]
    assert B._main(rows[0][2]) == ("T&&amp", f"A&ampB &&amp\n{WORDS * 3}x&lt y <z> &copy=1 &notit; & &lt; &amp")
    for name in oracle.TABLES:
        columns = list(zip(*rows, strict=True)) if name == "pages" else [(1,)] * 3
        pq.write_table(pa.table(dict(zip(("page_id", "url", "html"), columns, strict=True))), tmp_path / f"{name}.parquet")
    for name in ("main_content", "clean_pages", "stage_counts"):
        assert oracle.compare(spark, str(tmp_path), CATALOG[name].run, CATALOG[name].sql) == ""
