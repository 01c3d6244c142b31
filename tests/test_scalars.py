import random
from urllib.parse import urljoin

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions import arrays as A
from textloom.functions import html as H
from textloom.functions import text as T
from textloom.functions import url as U
from textloom.functions import vectors as V
from textloom.functions.stem import porter
from textloom.operators import answer, chunk, rows


def one(spark, column, **values):
    df = spark.range(1).select(*(F.lit(v).alias(k) if not isinstance(v, list) else F.array(*map(F.lit, v)).alias(k) for k, v in values.items())) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "url,want",
    [
        ("https://example.com/a/?b=2&a=1&utm_medium=x", "https://example.com/a?a=1&b=2"),
        ("HTTP://Example.COM", "http://example.com/"),
        (" https://h/p/#top", "https://h/p"),
        ("https://h/?q=&fbclid=1", "https://h/?q="),
        ("https://h/?b=x%20y&a=%7E*", "https://h/?a=~%2A&b=x+y"),
        ("//h/x", "http://h/x"),
    ],
)
def test_canonical(spark, url, want):
    assert one(spark, U.canonical("u"), u=url) == want


BASES = ["http://a/b/c/d?q#f", "https://h", "http://h/x/"]
HREFS = ["g", "./g", "g/", "/g", "//g/x", "?y", "g?y", "#s", "g#s", "g?y#s", "", ".", "./", "..", "../", "../g", "../../g", "http://x/y", "mailto:a@b", "../../../g", "/./g", "/a/../g"]


def test_absolute_as_the_standard_library(spark):
    df = spark.createDataFrame([(b, h) for b in BASES for h in HREFS], "b string, h string")
    odd = {("https://h", "?y"), ("https://h", "#s"), ("https://h", "")}
    for r in df.select("b", "h", U.absolute("b", "h").alias("x")).collect():
        if (r.b, r.h) not in odd:
            assert r.x == urljoin(r.b, r.h), (r.b, r.h)


def test_admission(spark):
    go = lambda u, **o: one(spark, U.admitted(F.lit(u), F.lit("http://a.com/"), ["/login"], **o))
    assert go("http://A.com/x") and not go("http://b.com/x") and not go("http://a.com/LOGIN") and not go("mailto:x@a.com")
    assert go("http://b.com/", allow=["B.com"]) and go("http://b.com/", same_domain_only=False)


def test_html(spark):
    page = "<html><head><title> A &amp; B </title><style>x</style></head><body><nav>menu</nav><h1>One</h1><p>first<br>line</p><script>var a='</p>'</script><!-- no --><h2 class=x>Two <b>b</b></h2> tail &lt;x&gt; <a href='/q'>l</a><A HREF=\"z\">m</A></body></html>"
    assert one(spark, H.title("h"), h=page) == "A & B"
    assert one(spark, H.to_text("h"), h=page) == "One\nfirst\nline\nTwo\nb\ntail <x>\nl\nm"
    assert one(spark, H.hrefs("h"), h=page) == ["/q", "z"]
    s = one(spark, H.sections("h"), h=page)
    assert [(r.header, r.content) for r in s] == [("", ""), ("One", "first\nline"), ("Two b", "tail <x>\nl\nm")]


def test_text(spark):
    assert one(spark, T.normalize("t"), t="  A \n b\t") == "a b"
    assert one(spark, T.truncate("t", 5), t="abcd fgh") == "abcd…" and one(spark, T.truncate("t", 5), t=" abcde ") == "abcde"
    assert one(spark, T.tokenize("t"), t="It's x-1 É") == ["it", "s", "x", "1"]
    assert one(spark, T.with_title(F.lit(" "), "t"), t="x") == "x" and one(spark, T.with_title(F.lit("T"), "t", "\n"), t="x") == "T\nx"
    assert one(spark, T.smart_join("a", "b"), a="x ", b=" y") == "x y" and one(spark, T.smart_join("a", "b"), a=" ", b=" y") == "y"
    assert one(spark, T.overlap_matches("a", "b", 2), a="xyz", b="yzq") and not one(spark, T.overlap_matches("a", "b", 2), a="z", b="zq")
    assert one(spark, T.clamp("a"), a="1.5") == 1 and one(spark, T.clamp("a"), a="x") == 0 and one(spark, T.clamp("a"), a="NaN") == 0
    assert one(spark, T.query_text("a", 3, 4), a="ab") is None and one(spark, T.query_text("a", 3, 4), a=" abc d") == "abc"


def test_ids(spark):
    assert one(spark, A.valid_ids("a", 5), a=["2", "0", "x", "2", "9"]) == [0, 2]
    inside, out = A.in_domain(F.array(F.lit(1)), F.array(F.lit(1)), 3)
    assert one(spark, inside) == [] and one(spark, out) == [1, 2, 3]
    inside, out = A.in_domain(F.array(F.lit(1)), F.array(F.lit(1)), 3, "in")
    assert one(spark, inside) == [1] and one(spark, out) == [2, 3]


def test_vectors(spark):
    assert one(spark, V.cosine("a", "b"), a=[3.0, 4.0], b=[4.0, 3.0]) == pytest.approx(0.96)
    assert one(spark, V.l2_normalize("a"), a=[0.0, 0.0]) == [0, 0]
    assert one(spark, V.last_logit("a"), a=[0.1, 0.9]) == 0.9


@pytest.mark.parametrize("word,stem", [("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("feed", "feed"), ("agreed", "agre"), ("plastered", "plaster"), ("motoring", "motor"), ("conflated", "conflat"), ("hopping", "hop"), ("falling", "fall"), ("filing", "file"), ("happy", "happi"), ("sky", "sky"), ("relational", "relat"), ("generalizations", "gener"), ("triplicate", "triplic"), ("hopefulness", "hope"), ("adjustment", "adjust"), ("adoption", "adopt"), ("probate", "probat"), ("rate", "rate"), ("controll", "control"), ("roll", "roll")])
def test_porter(word, stem):
    assert porter(word) == stem


def test_noise(spark):
    assert one(spark, chunk.is_noise("t", 10), t="Home | News | Sports | Politics | Economy")
    assert one(spark, chunk.is_noise("t"), t=None or "") and not one(spark, chunk.is_noise("t"), t="plain words " * 40)
    assert one(spark, chunk.is_noise("t"), t="please accept  cookies " + "x" * 300) and not one(spark, chunk.is_noise("t"), t="accept cookies " + "x" * 700)
    body = ("A paragraph of real content that is long enough to stay. " * 6).strip()
    assert one(spark, chunk.trim_edges("t"), t=f"Accept cookies | Newsletter\n\n{body}\n\nAll rights reserved") == body
    assert one(spark, chunk.trim_edges("t"), t="Accept cookies\n\nnewsletter") == ""


def test_windows(spark):
    t = "Hello world. This is second sentence! Third one?"
    assert one(spark, chunk.windows("t", 20, 5), t=t) == [t[i : i + 20].strip() for i in range(0, len(t), 15)]
    with pytest.raises(ValueError):
        chunk.windows("t", 10, 10)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(alphabet="ab .\n", max_size=120), st.integers(1, 30), st.data())
def test_windows_cover_the_text(spark, text, window, data):
    overlap = data.draw(st.integers(0, window - 1))
    made = one(spark, chunk.windows("t", window, overlap), t=text)
    stripped = text.strip(" \t\n\r\f\v")
    want = [w for i in range(0, len(stripped), window - overlap) if (w := stripped[i : i + window].strip(" \t\n\r\f\v"))]
    assert made == want


def test_sentence_ends(spark):
    t = "Hello world. This is second sentence! Third one?"
    assert [t[i] for i in chunk.sentence_ends(t)] == [".", "!", "?"]
    assert one(spark, chunk.last_sentence_end("t", F.lit(0), F.lit(40)), t=t) == t.index("!")
    assert one(spark, chunk.last_sentence_end("t", F.lit(0), F.lit(5)), t=t) is None


def test_repair():
    head, tail = "First part. " * 30, "x" * 60
    assert chunk.repair("", "b") == ("", "b", "") and chunk.repair("a", None) == ("a", None, "")
    # equal overlap with an end in it: cur is cut there, next starts after its own
    overlap = "and so it went. Then more words follow"
    cur, nxt, carry = chunk.repair(head + overlap, overlap + " until it ends.", overlap=len(overlap), min_len=10)
    assert cur.endswith("went.") and nxt.startswith("Then more") and carry == ""
    # no end in the overlap, one before it: the gap is carried over
    cur, nxt, carry = chunk.repair(head + "gap words " + tail, tail + " rest", overlap=60, min_len=10)
    assert cur.endswith("part.") and carry == "gap words" and nxt.startswith("gap words x")
    # none but in next: its head closes the sentence
    long = "y" * 400
    cur, nxt, carry = chunk.repair(long + tail, tail + " closes. New one", overlap=60, min_len=10)
    assert cur.endswith("closes.") and nxt == "New one"
    # different overlap: only what is found again in next moves
    cur, nxt, _ = chunk.repair(head + "End here. lost words", "zzz lost words and on", overlap=30, min_len=10)
    assert cur.endswith("End here.") and nxt.startswith("lost words")
    assert chunk.repair(head + "End here. lost", "nothing", overlap=30, min_len=10)[1] == "nothing"


def test_split_long():
    rng = random.Random(1)
    text = "\n\n".join(" ".join("w" * rng.randint(1, 12) for _ in range(rng.randint(1, 60))) for _ in range(8))
    parts = chunk.split_long(text, 100)
    assert all(0 < len(p) <= 100 for p in parts) and "".join("".join(parts).split()) == "".join(text.split())


def test_pack_paragraphs(spark):
    t = "a b c\n\nd e\n\nf g h i j k\n\nl"
    assert one(spark, chunk.pack_paragraphs("t", 5), t=t) == ["a b c\n\nd e", "f g h i j k", "l"]


def test_router_and_context(spark):
    assert tuple(one(spark, answer.route("q", ["CMU"]), q=" "))[:2] == (False, 0.0)
    assert tuple(one(spark, answer.route("q", ["CMU"]), q="about cmu"))[:2] == (True, 0.99)
    c = one(spark, answer.context(F.array(F.lit("a" * 30), F.lit("b" * 30), F.lit("c")), 2, 20))
    assert c == "Document:\n" + "a" * 30 + "\n\nDocument:\n" + "b" * 13 + "…"
    assert one(spark, answer.decision(F.lit(True), F.lit("0.2"))) is False and one(spark, answer.decision(F.lit(True), F.lit("0.7"))) is True
    assert one(spark, answer.valid_answer("a", ["not answerable"]), a="It is NOT answerable") == ""


def test_structure_and_header(spark):
    assert one(spark, rows.structure_chars("j"), j='{"pages":[{"blocks":[{"text":"abc"},{}]},{}]}') == 3
    h = F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.lit("1"), F.lit("c"), F.lit(" "))
    assert one(spark, T.header_text(h, "t"), t=" body ") == "a:1, b:2\nbody"
