"""Chunks: windows, sections, noise, and sentence-aligned boundaries."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.functions import html as H
from textloom.functions import text as T

# fixed values: phrases of boilerplate, strong and weak
STRONG = [
    r"accept\s+cookies",
    r"cookie\s+settings",
    r"manage\s+cookies",
    r"consent\s+preferences?",
    r"do\s+not\s+sell\s+my\s+personal\s+information",
    r"your\s+privacy\s+choices?",
    r"advertis(e|ing|ement)",
    r"sponsored\s+content",
    r"subscribe\s+to",
    r"sign\s+up\s+for",
    r"newsletter",
]
WEAK = [
    r"cookie\s+policy",
    r"privacy\s+policy",
    r"terms\s+of\s+service",
    r"terms\s+and\s+conditions",
    r"all\s+rights\s+reserved",
    r"copyright\s*(?:©\s*)?\d{4}",
    r"related\s+articles",
    r"related\s+posts",
    r"more\s+from\s+this\s+(?:author|category|section)",
]
SEPARATORS = "|•»›"
STRONG_RE, WEAK_RE = ("(?i)" + "|".join(f"(?:{p})" for p in ps) for ps in (STRONG, WEAK))
# fixed value: what divides the parts whose edges are trimmed
EDGE_RE = rf"\n\n+|{T.WS}*\|{T.WS}*|{T.WS}*[•»›]{T.WS}*"
SENTENCE_RE = r"""[.!?…。！？]+["')\]”’]*(?:[ \t\n\r]|$)"""


def windows(text, window: int = 1200, overlap: int = 200) -> Column:
    """Array of stripped windows of `window` characters, each starting window - overlap after the last; blank ones go."""
    if window <= 0 or not 0 <= overlap < window:
        raise ValueError("window is positive and 0 <= overlap < window")
    step = window - overlap

    def cut(t: Column) -> Column:
        starts = F.when(F.length(t) > 0, F.sequence(F.lit(0), F.length(t) - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
        return F.filter(F.transform(starts, lambda i: T.strip(F.substring(t, i + 1, F.lit(window)))), lambda c: c != "")

    return T.let(T.strip(T.safe(text)), cut)


def sliding(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 1200, overlap: int = 200) -> DataFrame:
    """(key, chunk_index, chunk_text, chunk_text_hash, chunk_id) of each document's windows."""
    cut = docs.select(key, F.posexplode(windows(text, window, overlap)).alias("chunk_index", "chunk_text"))
    return with_ids(cut)


def with_ids(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("chunk_text_hash", T.sha256("chunk_text")).withColumn("chunk_id", F.left("chunk_text_hash", F.lit(24)))


def is_noise(text, min_chars: int = 200) -> Column:
    """Whether a trimmed chunk is boilerplate: empty, short, short with separators, or of the phrases above where it is not long."""
    t = T.strip(T.safe(text))
    n = F.length(t)
    return (
        F.when(n == 0, True)
        .when(n < min_chars, True)
        .when((n < 250) & (T.count_chars(t, SEPARATORS) >= 4), True)
        .when((n < 600) & t.rlike(STRONG_RE), True)
        .when((n < 250) & t.rlike(WEAK_RE), True)
        .otherwise(False)
    )


def trim_edges(text) -> Column:
    """Boilerplate parts taken off both ends; parts are divided by blank lines and separators and joined by blank lines."""

    def noisy(p: Column, cap: Column) -> Column:
        short = F.length(p) < cap
        return (short & (T.count_chars(p, "\n") >= 2)) | p.rlike(STRONG_RE) | (short & p.rlike(WEAK_RE)) | (short & (T.count_chars(p, SEPARATORS) >= 3))

    def between(x: Column) -> Column:
        first = F.array_position(x["flags"], False)
        last = F.size(x["flags"]) - F.array_position(F.reverse(x["flags"]), False) + 1
        return F.when(first == 0, "").otherwise(F.array_join(F.slice(x["parts"], first.cast("int"), (last - first + 1).cast("int")), "\n\n"))

    def split(t: Column) -> Column:
        cap = F.least(F.lit(120), F.floor(F.length(t) * F.lit(0.35)).cast("int"))
        parts = F.filter(F.transform(F.split(t, EDGE_RE), T.strip), lambda p: p != "")
        return T.let(F.struct(cap.alias("cap"), parts.alias("parts")), lambda x: T.let(F.struct(x["parts"].alias("parts"), F.transform(x["parts"], lambda p: noisy(p, x["cap"])).alias("flags")), between))

    return T.let(T.strip(T.safe(text)), split)


def sections(pages: DataFrame, key: str, html: str = "html", min_chars: int = 250) -> DataFrame:
    """(key, chunk_index, header, chunk_text) of each page's h1/h2 sections, with a title line, of min_chars or more with it; numbered anew."""
    cut = pages.select(key, H.title(html).alias("title"), F.posexplode(H.sections(html)).alias("at", "part"))
    headers = F.create_map(F.lit("section"), F.col("part.header"), F.lit("title"), F.col("title"))
    made = cut.select(key, "at", F.col("part.header").alias("header"), T.header_text(headers, F.col("part.content")).alias("chunk_text")).filter((F.col("chunk_text") != "") & (F.length("chunk_text") >= min_chars))
    w = Window.partitionBy(key).orderBy("at")
    return made.select(key, (F.row_number().over(w) - 1).alias("chunk_index"), "header", "chunk_text")


def split_long(text: str, limit: int, separators: tuple[str, ...] = ("\n\n", "\n", ". ", " ")) -> list[str]:
    """Pieces of at most `limit` characters, cut at the coarsest separator that serves."""
    text = text.strip()
    if len(text) <= limit:
        return [text] if text else []
    for s in separators:
        if s in text:
            out, held = [], ""
            for part in text.split(s):
                joined = held + s + part if held else part
                if len(joined) <= limit:
                    held = joined
                else:
                    out += split_long(held, limit, separators)
                    held = part
            return out + (split_long(held, limit, separators) if held != text else [held[i : i + limit] for i in range(0, len(held), limit)])
    return [text[i : i + limit] for i in range(0, len(text), limit)]


def split_sections(chunks: DataFrame, limit: int = 1000) -> DataFrame:
    """Chunks longer than `limit` in pieces; a column piece numbers them."""

    @F.pandas_udf("array<string>")
    def pieces(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: split_long(t or "", limit))

    rest = [c for c in chunks.columns if c != "chunk_text"]
    return chunks.select(*rest, F.posexplode(pieces("chunk_text")).alias("piece", "chunk_text"))


def pack_paragraphs(text, max_tokens: int = 256) -> Column:
    """Consecutive paragraphs joined while they hold at most max_tokens words: the token-budget chunker."""
    words = lambda p: F.size(F.filter(F.split(p, rf"{T.WS}+"), lambda w: w != ""))
    paragraphs = F.filter(F.transform(F.split(T.safe(text), r"\n[ \t]*\n"), T.strip), lambda p: p != "")
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("held"), F.lit(0).alias("n"))

    def step(acc: Column, p: Column) -> Column:
        fits = (acc["held"] != "") & (acc["n"] + words(p) <= max_tokens)
        return F.when(fits, F.struct(acc["done"].alias("done"), F.concat(acc["held"], F.lit("\n\n"), p).alias("held"), (acc["n"] + words(p)).alias("n"))).otherwise(
            F.struct(F.when(acc["held"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["held"]))).alias("done"), p.alias("held"), words(p).alias("n"))
        )

    end = F.aggregate(paragraphs, empty, step)
    return F.when(end["held"] == "", end["done"]).otherwise(F.concat(end["done"], F.array(end["held"])))


def words(text) -> Column:
    """Array of what stands between white space: the default tokens of a budget."""
    return F.filter(F.split(T.safe(text), rf"{T.WS}+"), lambda w: w != "")


def headed(blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, pos, path, text) of what headings head, of blocks (key, pos, level, text; level 1 to 6 for headings, 0
    or null for the rest): path has the headings above, each under a higher one.  A document's blocks meet in one window."""
    before = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    level = F.coalesce(F.col("level"), F.lit(0))
    last = lambda least, most: F.max(F.when((level >= least) & (level <= most), F.struct("pos", "text"))).over(before)
    rows = blocks.select(key, "pos", level.alias("level"), T.strip(T.safe("text")).alias("text"), *(last(i, i).alias(f"h{i}") for i in range(1, 7)), *(last(1, i)["pos"].alias(f"p{i}") for i in range(1, 7)))
    # a heading holds until one of its level or above follows
    path = F.filter(F.array(*(F.when(F.col(f"h{i}.pos") == F.col(f"p{i}"), F.col(f"h{i}.text")) for i in range(1, 7))), lambda h: h.isNotNull() & (h != ""))
    return rows.filter((F.col("level") == 0) & (F.col("text") != "")).select(key, "pos", path.alias("path"), "text")


def token_chunks(blocks: DataFrame, key: str = "doc_id", max_tokens: int = 256) -> DataFrame:
    """(key, chunk_index, path, n_tokens, chunk_text) of blocks (key, pos, level, text): text under its headings.

    A block of more words than the budget leaves is cut between words.  Peers, blocks in a row under the same
    headings, are merged while they fit.  A chunk's text begins with its headings, a line each, which count as
    well; headings that alone fill the budget are left out of the text, not of path."""
    if max_tokens < 1:
        raise ValueError("max_tokens is positive")
    lead = F.aggregate("path", F.lit(0), lambda n, h: n + F.size(words(h)))
    rows = headed(blocks, key).withColumn("lead", lead).withColumn("lead", F.when(F.col("lead") < max_tokens, F.col("lead")).otherwise(0)).withColumn("room", F.lit(max_tokens) - F.col("lead"))
    # runs of equal paths: a running count of changes
    order = Window.partitionBy(key).orderBy("pos")
    rows = rows.withColumn("__new", (~F.col("path").eqNullSafe(F.lag("path").over(order))).cast("int"))
    rows = rows.withColumn("__run", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    cut = T.let(words("text"), lambda w: F.when(F.size(w) <= F.col("room"), F.array(F.struct(F.col("text").alias("t"), F.size(w).alias("n")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(w) - 1, F.col("room")), lambda i: T.let(F.slice(w, i + 1, F.col("room")), lambda x: F.struct(F.array_join(x, " ").alias("t"), F.size(x).alias("n"))))))
    runs = rows.withColumn("cut", cut).groupBy(key, "__run").agg(F.first("path").alias("path"), F.first("lead").alias("lead"), F.first("room").alias("room"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", "cut"))), lambda x: x["cut"])).alias("items"))

    empty = F.struct(F.array().cast("array<struct<t:string,n:int>>").alias("done"), F.lit("").alias("t"), F.lit(0).alias("n"))

    def step(acc: Column, x: Column) -> Column:
        fits = acc["n"] + x["n"] <= F.col("room")
        held = F.struct(acc["t"].alias("t"), acc["n"].alias("n"))
        return (
            F.when(acc["n"] == 0, F.struct(acc["done"].alias("done"), x["t"].alias("t"), x["n"].alias("n")))
            .when(fits, F.struct(acc["done"].alias("done"), F.concat(acc["t"], F.lit("\n"), x["t"]).alias("t"), (acc["n"] + x["n"]).alias("n")))
            .otherwise(F.struct(F.concat(acc["done"], F.array(held)).alias("done"), x["t"].alias("t"), x["n"].alias("n")))
        )

    packed = F.aggregate("items", empty, step, lambda acc: F.concat(acc["done"], F.array(F.struct(acc["t"].alias("t"), acc["n"].alias("n")))))
    each = runs.select(key, "__run", "path", "lead", F.posexplode(packed).alias("__i", "c"))
    shown = F.when(F.col("lead") > 0, F.concat(F.array_join("path", "\n"), F.lit("\n"), F.col("c.t"))).otherwise(F.col("c.t"))
    place = F.row_number().over(Window.partitionBy(key).orderBy("__run", "__i")) - 1
    return each.select(key, place.alias("chunk_index"), "path", (F.col("lead") + F.col("c.n")).alias("n_tokens"), shown.alias("chunk_text"))


def structure_blocks(docs: DataFrame, key: str, json: str) -> DataFrame:
    """(key, pos, level, text) of a document's structure: JSON of pages and their blocks, each with a text and, for headings, a level."""
    each = docs.select(key, F.posexplode(F.from_json(json, "pages array<struct<blocks: array<struct<text: string, level: int>>>>")["pages"]).alias("p", "page"))
    each = each.select(key, "p", F.posexplode("page.blocks").alias("b", "block"))
    return each.select(key, F.struct("p", "b").alias("pos"), F.col("block.level").alias("level"), F.col("block.text").alias("text"))


# --- sentence-aligned boundaries --------------------------------------------------------------


def sentence_ends(text: str) -> list[int]:
    """Places of the last character of each sentence: terminators with closing marks, before white space or the end.
    The end of a text without a terminator is no sentence end: it is where a window happened to stop."""
    return [m.end() - 1 - m.group()[-1].isspace() for m in re.finditer(SENTENCE_RE, text)]


def last_sentence_end(text, start, end) -> Column:
    """The last place in [start, end) that ends a sentence by a terminator; null if none.  One expression over the
    window, with the character after it, which tells whether a terminator at its end ends a sentence."""
    ends = r"(?s)^(.*[.!?…。！？])"

    def last(x: Column) -> Column:
        found = F.when(x["whole"], F.regexp_extract(x["w"], ends + r"(?:[ \n\t\r]|\z)", 1)).otherwise(F.regexp_extract(x["w"], ends + r"[ \n\t\r]", 1))
        return T.let(found, lambda m: F.when(m != "", x["s"] + F.length(m) - 1))

    def window(t: Column) -> Column:
        s, e = F.greatest(T.col(start), F.lit(0)), F.least(T.col(end), F.length(t))
        return T.let(F.struct(s.alias("s"), (e >= F.length(t)).alias("whole"), F.substring(t, s + 1, F.greatest(e - s, F.lit(0)) + F.when((e < F.length(t)) & (e > s), 1).otherwise(0)).alias("w")), last)

    return T.let(T.safe(text), window)


def _seam(cur: str, nxt: str, overlap: int, back: int, forward: int) -> tuple[int, int] | None:
    """(zone, place) of the sentence end that serves best as the boundary of two chunks with equal overlaps.

    Places count in the text that both make up, of which cur is the start and nxt the end.  Zones, best
    first: 0 the overlap, 1 `back` characters before it, 2 `forward` characters after it; in a zone the last end.
    """
    right, left = len(cur), len(cur) - overlap
    first = max(0, left - back)
    ends = (first + e + 1 for e in sentence_ends((cur + nxt[overlap:])[first : right + forward]))
    best = min(((2 if e > right else 0 if e > left else 1, -e) for e in ends), default=None)
    return best and (best[0], -best[1])


def repair(cur: str, nxt: str | None, overlap: int = 120, back: int = 100, forward: int = 100, min_len: int = 400) -> tuple[str, str | None, str]:
    """Move the boundary of two overlapping chunks to a sentence end: (cur, next, carried text).

    With equal overlaps the end is that of _seam; what lies between it and the overlap is carried to the
    other chunk.  With different ones only an end in cur's last `overlap` characters serves, if what it
    cuts off occurs in next.  A boundary that leaves less than min_len characters in cur changes nothing.
    """
    cur, nxt = (cur or "").strip(), None if nxt is None else nxt.strip()
    moved = None
    if cur and nxt and overlap > 0 and not (len(cur) >= overlap and nxt.startswith(cur[-overlap:])):
        ends = [e + 1 for e in sentence_ends(cur) if e >= len(cur) - overlap]
        gone = cur[ends[-1] :].strip() if ends else ""
        if ends and gone in nxt:
            moved = cur[: ends[-1]].rstrip(), nxt[nxt.index(gone) :].lstrip() if gone else nxt, ""
    elif cur and nxt and (seam := _seam(cur, nxt, overlap, back, forward)):
        zone, place = seam
        left = len(cur) - overlap
        if zone == 0:  # next loses the part of the overlap that stays with cur
            own = [e + 1 for e in sentence_ends(nxt) if e < overlap]
            moved = cur[:place].rstrip(), nxt[own[-1] :].lstrip() if own else nxt, ""
        elif zone == 1:
            carried = cur[place:left].strip()
            moved = cur[:place].rstrip(), " ".join(filter(None, [carried, nxt])), carried
        elif carried := nxt[: place - left].strip():
            moved = f"{cur} {carried}", nxt[place - left :].lstrip(), carried
    return moved if moved and len(moved[0]) >= min_len else (cur, nxt, "")


def repair_boundaries(chunks: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """(key, chunk_index, chunk_text): each document's chunks folded from left to right; a document's chunks meet in one task."""

    def fold(texts: pd.Series) -> pd.Series:
        def one(items):
            out = [t for _, t in sorted((r["i"], r["t"]) for r in items)]
            for i in range(len(out) - 1):
                out[i], out[i + 1], _ = repair(out[i], out[i + 1], **options)
            return out

        return texts.map(one)

    folded = F.pandas_udf(fold, "array<string>")
    lists = chunks.groupBy(key).agg(F.collect_list(F.struct(F.col("chunk_index").alias("i"), F.col("chunk_text").alias("t"))).alias("l"))
    return lists.select(key, F.posexplode(folded("l")).alias("chunk_index", "chunk_text")).filter("chunk_text <> ''")
