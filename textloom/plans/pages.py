"""Queries over pages: URLs, HTML, links, manifests, crawls."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import blocks as B
from textloom.functions import html as H
from textloom.functions import text as T
from textloom.functions import url as U
from textloom.operators import chunk, crawl, stages
from textloom.plans.common import Query, s_id, s_strip, scratch, table

pages = lambda spark, d: table(spark, d, "pages")
SEED, DROP, ALLOW = "http://spam-farm.example.org/", ["utm_", "PILLS"], ["spam-farm.example.org", "m.ththth.example.net"]


def url_hash(spark, d):
    return pages(spark, d).select("page_id", T.short_id("url").alias("url_hash"))


def document_ids(spark, d):
    return pages(spark, d).select("page_id", T.document_id("url", T.sha256("html")).alias("doc_id"))


def canonical_url(spark, d):
    return pages(spark, d).select("page_id", U.canonical("url").alias("canonical"))


def url_tests(spark, d):
    u = F.col("url")
    return pages(spark, d).select("page_id", U.host(u).alias("host"), U.same_domain(u, F.lit(SEED)).alias("same_domain"), U.is_http(u).alias("is_http"), U.should_drop(u, DROP).alias("dropped"))


def crawl_admission(spark, d):
    u = F.col("url")
    return pages(spark, d).select("page_id", U.admitted(u, F.lit(SEED), DROP).alias("by_domain"), U.admitted(u, F.lit(SEED), DROP, ALLOW).alias("by_list"), U.admitted(u, F.lit(SEED), [], None, False).alias("open"))


def html_text(spark, d):
    return pages(spark, d).select("page_id", H.to_text("html").alias("text"))


def main_content(spark, d):
    return crawl.contents(pages(spark, d)).select("page_id", "title", "text")


def html_title(spark, d):
    return pages(spark, d).select("page_id", H.title("html").alias("title"))


def html_sections(spark, d):
    p = pages(spark, d).select("page_id", F.posexplode(H.sections("html")).alias("place", "s"))
    return p.select("page_id", "place", "s.header", "s.content")


def section_chunks(spark, d):
    return chunk.split_sections(chunk.sections(pages(spark, d), "page_id"), 1000)


def semantic_chunks(spark, d):
    """Sections at h1 and h2 in chunks of 1,000 characters that hold tables, lists and code whole."""
    p = pages(spark, d).select("page_id", H.title("html").alias("title"), F.posexplode(B.semantic_chunks("html", 1000)).alias("chunk_index", "c"))
    return p.select("page_id", "title", "chunk_index", "c.header_1", "c.header_2", "c.chunk_text")


def token_chunks(spark, d):
    blocks = pages(spark, d).select("page_id", F.posexplode(B.outline("html")).alias("pos", "b")).select("page_id", "pos", "b.level", "b.text")
    return chunk.token_chunks(blocks, "page_id", 256)


def extract_links(spark, d):
    return crawl.links(pages(spark, d)).select("url", "pos", "href", "target")


def clean_pages(spark, d):
    return crawl.clean(pages(spark, d), 500, "2024-01-01")


def clean_counters(spark, d):
    return crawl.counters(pages(spark, d), 1500)


def stage_counts(spark, d):
    """What a cleaning stage observed while it wrote its rows."""
    with stages.Stage(spark, "clean", scratch(spark, "clean")) as stage:
        seen = stage.counted(pages(spark, d), "pages", total=F.count("*"), errors=F.count_if(F.col("html").isNull()))
        stage.write(crawl.clean(seen, 1500), kept=F.count("*"), chars=F.sum(F.length("text")))
    told = stages.read_json(spark, stage.stats["outputs"]["stats"])["counts"]
    return spark.createDataFrame(sorted(told.items()), "name string, value long")


def manifest_latest(spark, d):
    log = table(spark, d, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("url"), F.col("event_id").alias("ord"), F.col("event_type").alias("content_hash"))
    return crawl.latest(log)


def manifest_rows(spark, d):
    m = pages(spark, d).select("url", F.when(F.length("html") > 1500, F.concat(F.lit("raw/"), T.short_id("url"))).otherwise(" ").alias("rel_path"), F.when(F.contains("url", F.lit("utm_")), "image").otherwise("HTML").alias("content_type"))
    return crawl.valid_entries(m)


def seed_distinct(spark, d):
    u = F.col("url")
    blocks = pages(spark, d).select(F.col("page_id").alias("ord"), F.array(F.concat(U.scheme(u), F.lit("://"), U.host(u), F.lit("/")), F.concat(F.lit("https://"), U.host(u), F.lit("/"))).alias("urls"))
    return crawl.seeds(blocks)


def manifest_incremental(spark, d):
    p = pages(spark, d).withColumn("content_hash", T.sha256("html"))
    old = p.filter(F.length("html") > 1500).select("url", F.when(F.contains("url", F.lit("utm_")), "changed").otherwise(F.col("content_hash")).alias("content_hash"), F.concat(F.lit("old/"), T.short_id("url")).alias("rel_path"))
    return crawl.snapshot(crawl.latest(p.select("url", "content_hash", F.col("page_id").alias("ord"))).select("url", "content_hash"), crawl.latest(old.withColumn("ord", F.length("rel_path"))).select("url", "content_hash", "rel_path"))


JUMPS = [(2, 1), (3, 2), (5, 7), (1, 1)]
CRAWL = {"max_depth": 4, "max_links": 8, "per_seed": 30, "total": 300}


def linked_pages(spark, d):
    """Pages that lead to one another: to each page's html links to the pages numbered m * page_id + b, in a ring."""
    p = pages(spark, d)
    ring = p.agg(F.count("*").alias("n"))  # one row
    to = p.join(F.broadcast(ring)).select("page_id", F.posexplode(F.array(*((F.col("page_id") * m + b) % F.col("n") for m, b in JUMPS))).alias("k", "j"))
    anchor = F.concat(F.lit('<a href="'), F.replace(U.canonical("url"), F.lit("&"), F.lit("&amp;")), F.lit('">next</a>'))
    named = to.join(p.select(F.col("page_id").alias("j"), anchor.alias("a")), "j").groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("k", "a"))).alias("l"))  # a few of each page
    more = named.select("page_id", F.array_join(F.transform("l", lambda x: x["a"]), "").alias("more"))
    return p.join(more, "page_id", "left").select("page_id", "url", F.concat("html", F.coalesce("more", F.lit(""))).alias("html"))


def crawl_seeds(spark, d):
    """The stated query set: pages whose id is divisible by 20, in that order."""
    return pages(spark, d).filter("page_id % 20 = 0").select("url", F.col("page_id").alias("ord"))


def crawl_bfs(spark, d):
    return crawl.breadth_first(linked_pages(spark, d), crawl_seeds(spark, d), same_domain_only=False, **CRAWL)


def crawl_manifest(spark, d):
    return crawl.crawl_manifest(crawl_bfs(spark, d), crawl_seeds(spark, d))


PARTS = U.PARTS.replace("'", "''")
part = lambda i, u="url": f"regexp_extract(trim({u}), '{PARTS}', {i})"
HOST, SCHEME = f"lower({part(2)})", f"lower({part(1)})"
DROPPED = "(contains(lower(url), 'utm_') OR contains(lower(url), 'pills'))"


def s_unescape(x: str) -> str:
    for entity, char in H.ENTITIES.items():
        shown = char.replace("'", "''")
        x = f"replace({x}, '{entity}', '{shown}')"
    return x


def s_text(x: str) -> str:
    x = f"regexp_replace({x}, '(?s)<!--.*?-->', '', 'g')"
    for tag in H.DENIED:
        x = f"regexp_replace({x}, '{H.denied(tag)}', '', 'g')"
    x = f"regexp_replace({x}, '{H.denied('title')}', '', 'g')"
    lines = f"string_split({s_unescape(f'''regexp_replace({x}, '(?s)<[^>]*>', chr(10), 'g')''')}, chr(10))"
    return f"array_to_string(list_filter(list_transform({lines}, lambda l: {s_strip('l')}), lambda l: l <> ''), chr(10))"


def s_main(x: str) -> str:
    """What the extractor gives for pages of one article of headings and paragraphs."""
    article = f"regexp_replace(regexp_replace(regexp_extract({x}, '(?is)<article\\b[^>]*>(.*?)</article\\s*>', 1), '\\s+', ' ', 'g'), '(?i)</?b>', '', 'g')"
    return f"CASE WHEN length({s_text(article)}) >= 200 THEN {s_text(article)} ELSE {s_text(x)} END"


def s_title(x: str) -> str:
    return s_strip(s_unescape(f"regexp_extract({x}, '(?is)<title\\b[^>]*>(.*?)</title\\s*>', 1)"))


def s_canonical(rows: str, out: str, keep: str) -> str:
    """Table `out` of the columns `keep`, url and canonical from the rows of a table with a url."""
    return f"""
{out}_p AS (SELECT {keep}, url, {SCHEME} AS s, {HOST} AS h, {part(3)} AS path, string_split({part(4)}, '&') AS pairs FROM {rows}),
{out}_q AS (SELECT *, list_sort(list_filter(list_transform(list_filter(pairs, lambda x: x <> ''), lambda x: {{'k': split_part(x, '=', 1), 'v': CASE WHEN contains(x, '=') THEN substr(x, strpos(x, '=') + 1) ELSE '' END}}), lambda x: NOT regexp_matches(x.k, '(?i){U.TRACKING}'))) AS kept FROM {out}_p),
{out} AS (SELECT {keep}, url, CASE WHEN s = '' THEN 'http' ELSE s END || '://' || h || CASE WHEN path = '' THEN '/' WHEN path <> '/' THEN regexp_replace(path, '/$', '') ELSE path END
  || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(list_transform(kept, lambda x: x.k || '=' || x.v), '&') ELSE '' END AS canonical FROM {out}_q)
"""


CANONICAL = s_canonical("pages", "canon", "page_id")
HREF = r"""(?is)<a\b[^>]*?\bhref\s*=\s*("[^"]*"|''[^'']*'')"""
LINKS = f"list_transform(regexp_extract_all(html, '{HREF}', 1), lambda x: {s_unescape(s_strip('substr(x, 2, length(x) - 2)'))})"

# a queue in SQL: each step takes the next URL of the queue, or the next seed
CRAWLED = f"""WITH RECURSIVE {CANONICAL},
jump AS (SELECT page_id, k, (page_id * m + b) % (SELECT count(*) FROM pages) AS j FROM pages, (VALUES {", ".join(f"({i}, {m}, {b})" for i, (m, b) in enumerate(JUMPS))}) t(k, m, b)),
more AS (SELECT jump.page_id, string_agg('<a href="' || replace(canonical, '&', '&amp;') || '">next</a>', '' ORDER BY k) AS a FROM jump JOIN canon ON canon.page_id = j GROUP BY jump.page_id),
one AS MATERIALIZED (SELECT canonical AS url, arg_min(h, {{'u': url, 'h': h}}) AS html FROM (SELECT canonical, canon.url, html || coalesce(a, '') AS h FROM canon JOIN pages USING (page_id) LEFT JOIN more USING (page_id)) GROUP BY canonical),
link AS (SELECT url AS page, unnest(l) AS href, unnest(range(len(l))) AS pos FROM (SELECT url, {LINKS} AS l FROM one)),
aim AS (SELECT page, pos, CASE WHEN starts_with(href, 'http') THEN href ELSE {part(1, 'page')} || '://' || {part(2, 'page')} || href END AS url FROM link),
{s_canonical("aim", "aimed", "page, pos")},
graph AS MATERIALIZED (SELECT page, list(u ORDER BY pos) AS us FROM (SELECT page, canonical AS u, min(pos) AS pos FROM aimed GROUP BY ALL) GROUP BY page),
seeds AS MATERIALIZED (SELECT seed, ord, row_number() OVER (ORDER BY ord, seed) AS s FROM (SELECT canonical AS seed, min(page_id) AS ord FROM canon WHERE page_id % 20 = 0 GROUP BY canonical)),
walk AS (
  SELECT s, 0 AS i, [{{'u': seed, 'd': 0, 'b': ''}}] AS q, [seed] AS met, 0 AS f, 0 AS total, seed, CAST(NULL AS VARCHAR) AS url, 0 AS depth, '' AS found_by, 0 AS place FROM seeds WHERE s = 1
  UNION ALL
  SELECT CASE WHEN ended THEN s + 1 ELSE s END, CASE WHEN ended THEN 0 ELSE i + 1 END,
    CASE WHEN ended THEN [{{'u': next_seed, 'd': 0, 'b': ''}}] ELSE list_concat(q, list_transform(new, lambda u: {{'u': u, 'd': x.d + 1, 'b': x.u}})) END,
    CASE WHEN ended THEN [next_seed] ELSE list_concat(met, new) END,
    CASE WHEN ended THEN 0 WHEN is_page THEN f + 1 ELSE f END, CASE WHEN is_page AND NOT ended THEN total + 1 ELSE total END,
    CASE WHEN ended THEN next_seed ELSE seed END, CASE WHEN is_page AND NOT ended THEN x.u END, x.d, x.b, f
  FROM (SELECT w.*, n.seed AS next_seed, w.i >= len(w.q) OR w.f >= {CRAWL["per_seed"]} AS ended, o.url IS NOT NULL AS is_page, w.q[w.i + 1] AS x,
      CASE WHEN o.url IS NOT NULL AND w.q[w.i + 1].d < {CRAWL["max_depth"]} THEN list_filter(coalesce(g.us, []), lambda u: NOT list_contains(w.met, u))[1:{CRAWL["max_links"]}] ELSE [] END AS new
    FROM (SELECT s, i, q, met, f, total, seed FROM walk) w LEFT JOIN seeds n ON n.s = w.s + 1 LEFT JOIN one o ON o.url = w.q[w.i + 1].u LEFT JOIN graph g ON g.page = w.q[w.i + 1].u)
  WHERE total < {CRAWL["total"]} AND NOT (ended AND next_seed IS NULL)),
found AS (SELECT seed, url, CAST(depth AS INTEGER) AS depth, found_by, CAST(place AS INTEGER) AS place FROM walk WHERE url IS NOT NULL)"""

QUERIES = {
    "url_hash": Query(url_hash, f"SELECT page_id, {s_id('url')} AS url_hash FROM pages"),
    "document_ids": Query(document_ids, f"SELECT page_id, {s_id('url || sha256(html)')} AS doc_id FROM pages"),
    "canonical_url": Query(canonical_url, f"WITH {CANONICAL} SELECT page_id, canonical FROM canon"),
    "url_tests": Query(url_tests, f"SELECT page_id, {HOST} AS host, {HOST} = 'spam-farm.example.org' AS same_domain, {SCHEME} IN ('http', 'https') AND {HOST} <> '' AS is_http, {DROPPED} AS dropped FROM pages"),
    "crawl_admission": Query(crawl_admission, f"SELECT page_id, NOT {DROPPED} AND {HOST} = 'spam-farm.example.org' AS by_domain, NOT {DROPPED} AND {HOST} IN ('spam-farm.example.org', 'm.ththth.example.net') AS by_list, {SCHEME} IN ('http', 'https') AND {HOST} <> '' AS open FROM pages"),
    "html_text": Query(html_text, f"SELECT page_id, {s_text('html')} AS text FROM pages"),
    "main_content": Query(main_content, f"SELECT page_id, {s_title('html')} AS title, {s_main('html')} AS text FROM pages"),
    "html_title": Query(html_title, f"SELECT page_id, {s_title('html')} AS title FROM pages"),
    "html_sections": Query(html_sections, f"""WITH p AS (SELECT page_id, string_split(regexp_replace(html, '(?is)<h[12]\\b[^>]*>', chr(1), 'g'), chr(1)) AS l FROM pages), e AS (SELECT page_id, unnest(l) AS x, CAST(unnest(range(len(l))) AS INTEGER) AS place FROM p)
        SELECT page_id, place, CASE WHEN place = 0 THEN '' ELSE {s_strip(f'''regexp_replace({s_unescape("regexp_replace(regexp_extract(x, '(?is)^(.*?)</h[12]\\s*>', 1), '(?s)<[^>]*>', ' ', 'g')")}, '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g')''')} END AS header,
        {s_text("(CASE WHEN place = 0 THEN x ELSE regexp_replace(x, '(?is)^.*?</h[12]\\s*>', '') END)")} AS content FROM e"""),
    "section_chunks": Query(section_chunks, None),
    "semantic_chunks": Query(semantic_chunks, None),
    "token_chunks": Query(token_chunks, None),
    "extract_links": Query(extract_links, f"SELECT url, CAST(pos AS INTEGER) AS pos, href, {part(1)} || '://' || {part(2)} || href AS target FROM (SELECT url, unnest(l) AS href, unnest(range(len(l))) AS pos FROM (SELECT url, {LINKS} AS l FROM pages))"),
    "clean_pages": Query(clean_pages, f"SELECT {s_id('url || sha256(html)')} AS doc_id, url, title, text, sha256(html) AS content_hash, 'html' AS content_type, '2024-01-01' AS run_date FROM (SELECT url, html, {s_title('html')} AS title, {s_main('html')} AS text FROM pages) WHERE length(text) >= 500"),
    "clean_counters": Query(clean_counters, f"SELECT count(*) AS total, count(*) FILTER (n >= 1500) AS kept, count(*) FILTER (n < 1500) AS dropped, count(*) FILTER (n IS NULL) AS errors FROM (SELECT length({s_main('html')}) AS n FROM pages)"),
    "stage_counts": Query(stage_counts, f"WITH n AS (SELECT html, length({s_main('html')}) AS n FROM pages) SELECT 'total' AS name, count(*) AS value FROM n UNION ALL SELECT 'errors', count(*) FILTER (html IS NULL) FROM n UNION ALL SELECT 'kept', count(*) FILTER (n >= 1500) FROM n UNION ALL SELECT 'chars', CAST(sum(n) FILTER (n >= 1500) AS BIGINT) FROM n"),
    "manifest_latest": Query(manifest_latest, "SELECT 'u' || user_id AS url, arg_max(event_type, event_id) AS content_hash, min(event_id) AS first_ord FROM events GROUP BY user_id"),
    "manifest_rows": Query(manifest_rows, f"SELECT url, 'raw/' || {s_id('url')} AS rel_path, 'HTML' AS content_type FROM pages WHERE length(html) > 1500 AND NOT contains(url, 'utm_')"),
    "seed_distinct": Query(seed_distinct, f"WITH e AS (SELECT page_id AS block, 0 AS place, {SCHEME} || '://' || {HOST} || '/' AS url FROM pages UNION ALL SELECT page_id, 1, 'https://' || {HOST} || '/' FROM pages) SELECT url, block, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY block, place) AS r FROM e) WHERE r = 1"),
    "manifest_incremental": Query(manifest_incremental, f"""WITH p AS (SELECT url, arg_max(sha256(html), page_id) AS h FROM pages GROUP BY url), o AS (SELECT url, max(CASE WHEN contains(url, 'utm_') THEN 'changed' ELSE sha256(html) END) AS h FROM pages WHERE length(html) > 1500 GROUP BY url)
        SELECT p.url, p.h AS content_hash, CASE WHEN p.h = o.h THEN 'old/' || {s_id('p.url')} ELSE 'raw/' || {s_id('p.url')} || '/' || left(p.h, 12) || '.html' END AS rel_path, coalesce(p.h = o.h, false) AS reused FROM p LEFT JOIN o USING (url)"""),
    "crawl_bfs": Query(crawl_bfs, f"{CRAWLED} SELECT * FROM found"),
    "crawl_manifest": Query(crawl_manifest, f"{CRAWLED} SELECT url, r.seed, r.depth, r.found_by, r.place FROM (SELECT url, arg_max(found, s.ord) AS r FROM found JOIN seeds s USING (seed) GROUP BY url)"),
}
