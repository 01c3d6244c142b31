"""Pages as a crawl sees them: manifests, links, and a breadth-first walk over a table of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.functions import blocks as B
from textloom.functions import html as H
from textloom.functions import text as T
from textloom.functions import url as U
from textloom.operators import mining
from textloom.operators.lineage import cut


def latest(entries: DataFrame, key: str = "url", order: str = "ord") -> DataFrame:
    """The last row of each key, with the place of its first (`first_ord`)."""
    named = [c for c in entries.columns if c not in (key, order)]
    out = entries.groupBy(key).agg(F.max(F.struct(order, *named)).alias("r"), F.min(order).alias("first_ord"))
    return out.select(key, *(F.col(f"r.{c}").alias(c) for c in named), "first_ord")


def seeds(blocks: DataFrame, blocks_col: str = "urls", order: str = "ord") -> DataFrame:
    """Distinct URLs of arrays, in the order of their first mention."""
    each = blocks.select(F.col(order).alias("o"), F.posexplode(blocks_col).alias("i", "url")).filter("url is not null")
    first = each.groupBy("url").agg(F.min(F.struct("o", "i")).alias("at"))
    return first.select("url", F.col("at.o").alias("block"), F.col("at.i").alias("place"))


def valid_entries(manifest: DataFrame) -> DataFrame:
    """Rows with url, rel_path and a known type."""
    return manifest.filter("trim(coalesce(url, '')) <> '' and trim(coalesce(rel_path, '')) <> ''").filter(F.lower("content_type").isin("html", "pdf"))


def snapshot(pages: DataFrame, previous: DataFrame) -> DataFrame:
    """This run's manifest of pages (url, content_hash): an unchanged page keeps its path, others get one of their hash."""
    old = previous.select("url", F.col("content_hash").alias("old_hash"), F.col("rel_path").alias("old_path"))
    fresh = F.concat(F.lit("raw/"), T.short_id("url"), F.lit("/"), F.left("content_hash", F.lit(12)), F.lit(".html"))
    same = F.coalesce(F.col("content_hash") == F.col("old_hash"), F.lit(False))
    return pages.join(old, "url", "left").select("url", "content_hash", F.when(same, F.col("old_path")).otherwise(fresh).alias("rel_path"), same.alias("reused"))


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, pos, href, target): links in document order, made absolute."""
    each = pages.select(F.col(url).alias("url"), F.posexplode(H.hrefs(html)).alias("pos", "href"))
    return each.withColumn("target", U.absolute("url", "href"))


LEAST = 200  # characters that the main content has, or else the whole page's text counts


def contents(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with title and text: the main content where it has LEAST characters, else all text outside the denied elements."""
    read = pages.withColumn("__main", B.main_content(html))
    enough = F.length("__main.text") >= LEAST
    title = F.when(enough & (F.col("__main.title") != ""), F.col("__main.title")).otherwise(H.title(html))
    return read.withColumn("title", title).withColumn("text", F.when(enough, F.col("__main.text")).otherwise(H.to_text(html))).drop("__main")


def clean(pages: DataFrame, min_chars: int = 200, run_date: str = "1970-01-01") -> DataFrame:
    """Documents of pages (url, html): ids, title, text; pages whose text is shorter than min_chars go."""
    t = contents(pages.select("url", "html")).withColumn("content_hash", T.sha256("html"))
    return t.filter(F.length("text") >= min_chars).select(T.document_id("url", "content_hash").alias("doc_id"), "url", "title", "text", "content_hash", F.lit("html").alias("content_type"), F.lit(run_date).alias("run_date"))


def counters(pages: DataFrame, min_chars: int = 200) -> DataFrame:
    """One row: total, kept and dropped pages and errors (no html)."""
    n = F.length("text")
    ok = F.col("html").isNotNull()
    one = lambda c: F.count_if(c)
    return contents(pages.select("html")).agg(F.count("*").alias("total"), one(ok & (n >= min_chars)).alias("kept"), one(ok & (n < min_chars)).alias("dropped"), one(~ok).alias("errors"))


def _claims(found: DataFrame, max_links: int) -> DataFrame:
    """Of links (seed, parent, pos, url, ..) found by one level's pages, those that a queue would take: pages come in
    order of parent, each takes its first max_links URLs that no earlier page has taken.

    All pages propose their first max_links links at once; a URL stays with the earliest page, and whatever later
    pages hold of it goes, so they propose further ones.  A page's links only ever go to earlier pages, so the
    rounds end, and they end where the queue does."""
    open_ = cut(found)
    w = Window.partitionBy("seed", "parent").orderBy("pos")
    while True:
        taken = open_.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= max_links).drop("n")
        holder = taken.groupBy("seed", "url").agg(F.min("parent").alias("holder"), F.max("parent").alias("last"))
        if holder.filter("last > holder").isEmpty():
            return taken
        open_ = cut(open_.join(holder.drop("last"), ["seed", "url"], "left").filter("holder is null or parent <= holder").drop("holder"))


def _within_total(seen: DataFrame, total: int) -> DataFrame:
    """Rows (s, place, ..) of seeds one after another, as many as the total allows."""
    counts = mining.sum_before(seen.groupBy("s").agg(F.count("*").alias("n")), "s", "n")
    return seen.join(counts.select("s", "before"), "s").filter(F.col("before") + F.col("place") < total).drop("before")


def breadth_first(pages: DataFrame, seed_urls: DataFrame, max_depth: int = 2, max_links: int = 30, per_seed: int = 200, total: int = 1000, drop: list[str] | None = None, allow: list[str] | None = None, same_domain_only: bool = True) -> DataFrame:
    """(seed, url, depth, found_by, place): what a queue for each seed fetches of a table of pages (url, html).

    Seeds (url, and ord for their order; by URL without it) are crawled one after another, each with visited URLs
    of its own.  A page adds its first `max_links` admitted links that its seed's crawl has not yet come across,
    whether or not they lead to a page; place is the order of fetching, from 0.  A seed ends after per_seed
    pages, the crawl after total pages of all seeds.  URLs are compared in canonical form; of pages with one
    form the one with the least URL and html counts, of seeds the first.  PDF pages lead nowhere.

    All seeds advance together, a level at a time; that budgets cut sequences in order lets the total be taken
    off afterwards (and seeds that it can't reach are left out early).  Windows are over a page's links or a
    seed's level, which the budgets bound."""
    one = pages.select(U.canonical("url").alias("at"), "url", F.coalesce("html", F.lit("")).alias("html")).filter("at is not null").groupBy("at").agg(F.min(F.struct("url", "html"))["html"].alias("html"))
    one = cut(one.select(F.col("at").alias("url"), "html"))
    targets = links(one.filter(~F.endswith(F.lower("url"), F.lit(".pdf")))).groupBy("url", U.canonical("target").alias("target")).agg(F.min("pos").alias("pos"))
    graph = cut(targets.filter("target is not null").select(F.col("url").alias("found_by"), F.col("target").alias("url"), "pos"))
    known = one.select("url")
    admitted = lambda rows: rows.filter(U.admitted("url", "seed", drop or [], allow, same_domain_only))
    given = seed_urls.filter("url is not null").select(U.canonical("url").alias("seed"), (F.col("ord") if "ord" in seed_urls.columns else F.lit(0)).cast("long").alias("ord"))
    order = given.groupBy("seed").agg(F.min("ord").alias("ord"))
    level = cut(mining.numbered(order, ["ord", "seed"], "s").select("seed", "s", F.col("seed").alias("url")))
    met = [admitted(level).select("seed", "url")]  # URLs that a seed's crawl has come across
    level = admitted(level).join(known, "url", "left_semi").select("seed", "s", "url", F.lit(0).alias("depth"), F.lit("").alias("found_by"), F.lit(0).alias("place"))
    seen = cut(_within_total(level, total))
    level = seen
    for depth in range(1, max_depth + 1):
        out = level.select("seed", "s", F.col("url").alias("found_by"), F.col("place").alias("parent")).join(graph, "found_by")
        before = met[0]
        for more in met[1:]:
            before = before.unionByName(more)
        claimed = cut(_claims(admitted(out).join(before, ["seed", "url"], "left_anti"), max_links))
        met.append(claimed.select("seed", "url"))
        have = seen.groupBy("seed").agg(F.count("*").cast("int").alias("have"))
        w = Window.partitionBy("seed").orderBy("parent", "pos")
        ranked = claimed.join(known, "url", "left_semi").withColumn("n", F.row_number().over(w)).join(have, "seed").withColumn("place", F.col("have") + F.col("n") - 1)
        ranked = ranked.filter(F.col("place") < min(per_seed, total)).select("seed", "s", "url", F.lit(depth).alias("depth"), "found_by", "place")
        both = cut(_within_total(seen.unionByName(ranked), total))
        level, seen = both.filter(F.col("depth") == depth), both
        if level.isEmpty():
            break
    return seen.select("seed", "url", "depth", "found_by", "place")


def crawl_manifest(found: DataFrame, seed_urls: DataFrame) -> DataFrame:
    """(url, seed, depth, found_by, place) of a crawl's pages, one row each: the last seed's that fetched it."""
    order = seed_urls.groupBy(U.canonical("url").alias("seed")).agg(F.min("ord").alias("ord"))
    return found.join(order, "seed").groupBy("url").agg(F.max(F.struct("ord", "seed", "depth", "found_by", "place")).alias("r")).select("url", "r.seed", "r.depth", "r.found_by", "r.place")
