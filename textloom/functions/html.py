"""HTML scalars by regular expressions that Java and RE2 read alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import col, safe, strip

# fixed values: elements whose content is no text of the page
DENIED = ["script", "style", "noscript", "header", "footer", "nav", "aside"]
# fixed values: named entities that are decoded, the ampersand last
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&amp;": "&"}


def denied(tag: str) -> str:
    return rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>"


def unescape(c: Column) -> Column:
    for entity, char in ENTITIES.items():
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def to_text(html) -> Column:
    """Text nodes outside the denied elements, one a line, stripped, without blank ones."""
    t = F.regexp_replace(safe(html), r"(?s)<!--.*?-->", "")
    for tag in DENIED:
        t = F.regexp_replace(t, denied(tag), "")
    t = F.regexp_replace(t, r"(?is)<title\b[^>]*>.*?</title\s*>", "")
    t = unescape(F.regexp_replace(t, r"(?s)<[^>]*>", "\n"))
    return F.array_join(F.filter(F.transform(F.split(t, "\n"), strip), lambda x: x != ""), "\n")


def title(html) -> Column:
    """The title element's text; empty where there is none."""
    return strip(unescape(F.regexp_extract(safe(html), r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)))


def hrefs(html) -> Column:
    """Targets of links in document order."""
    quoted = F.regexp_extract_all(safe(html), F.lit(r"""(?is)<a\b[^>]*?\bhref\s*=\s*("[^"]*"|'[^']*')"""), F.lit(1))
    return F.filter(F.transform(quoted, lambda q: unescape(strip(F.substring(q, F.lit(2), F.length(q) - 2)))), lambda h: h != "")


def sections(html) -> Column:
    """Array of (header, content): the text before the first h1 or h2, then of each of them."""
    parts = F.split(F.regexp_replace(safe(html), r"(?is)<h[12]\b[^>]*>", "\u0001"), "\u0001")
    return F.transform(
        parts,
        lambda p, i: F.struct(
            F.when(i == 0, F.lit("")).otherwise(strip(F.regexp_replace(unescape(F.regexp_replace(F.regexp_extract(p, r"(?is)^(.*?)</h[12]\s*>", 1), r"(?s)<[^>]*>", " ")), r"[ \t\n\r\f\x0B]+", " "))).alias("header"),
            to_text(F.when(i == 0, p).otherwise(F.regexp_replace(p, r"(?is)^.*?</h[12]\s*>", ""))).alias("content"),
        ),
    )
