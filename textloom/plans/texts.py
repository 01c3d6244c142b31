"""Queries over texts: scalars, chunks, noise, exact dedup, id arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import arrays as A
from textloom.functions import text as T
from textloom.functions.stem import analyzed_terms
from textloom.operators import answer, chunk, dedup, mining
from textloom.plans.common import TURNS, ASKED, CHUNKS, Query, WS, asked, benchmark, chunks, scratch, s_count, s_id, s_norm, s_rstrip, s_strip, s_tokens, table
from textloom.sources import jsonl

docs = lambda spark, d: table(spark, d, "documents")
STRONG, WEAK = chunk.STRONG_RE, chunk.WEAK_RE
HINTS = "what, how, why"
PHRASES = ["not answerable", "cannot be answered"]
# ids as a model might give them, from a number: not all are integers, some repeat or are out of range
IDS = [("a", "k % 7"), ("b", "k % 5"), ("c", "k"), ("d", "k % 7")]


def doc_hash(spark, d):
    return docs(spark, d).select("doc_id", T.sha256("text").alias("text_hash"))


def text_sha1(spark, d):
    return docs(spark, d).select("doc_id", T.text_sha1("text").alias("text_sha1"))


def normalize_text(spark, d):
    return docs(spark, d).select("doc_id", T.normalize("text").alias("normalized"))


def tokenize(spark, d):
    return docs(spark, d).select("doc_id", F.posexplode(T.tokenize("text")).alias("pos", "token")).groupBy("doc_id", "token").agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))


def stem_terms(spark, d):
    return analyzed_terms(table(spark, d, "benchmark"), "item_id", "text").groupBy("item_id", "term").agg(F.count("*").alias("tf"))


def chunk_ids(spark, d):
    return chunks(spark, d).select("doc_id", "chunk_index", "chunk_id", "chunk_text_hash")


def sliding_window_chunks(spark, d):
    return chunk.sliding(docs(spark, d), window=400, overlap=120).select("doc_id", "chunk_index", "chunk_text")


def query_ids(spark, d):
    return asked(spark, d).select("ord", "query_text_norm", "query_id")


def query_postprocess(spark, d):
    return asked(spark, d).select("ord", T.query_text("text", 40, 200).alias("query_text")).filter("query_text is not null")


def chunk_header(spark, d):
    h = F.create_map(F.lit("lang"), "lang", F.lit("source"), "source")
    return docs(spark, d).select("doc_id", T.header_text(h, "text").alias("chunk_text"))


def full_text(spark, d):
    return docs(spark, d).select("doc_id", T.with_title(T.first_line("text"), "text").alias("index_text"), T.with_title(T.first_line("text"), "text", "\n").alias("pair_text"), T.instructed("Represent the passage:", "text").alias("encoder_text"))


def truncate_text(spark, d):
    return docs(spark, d).select("doc_id", T.truncate("text", 200).alias("short"))


def clamp(spark, d):
    return table(spark, d, "events").select("event_id", T.clamp("value", 0.0, 10.0).alias("clamped"), T.clamp(F.element_at(F.split("props", '"'), -1), 0.0, 50.0, -1.0).alias("parsed"))


def iso_time(spark, d):
    return table(spark, d, "events").select("event_id", T.iso_z("ts").alias("iso"), T.epoch_ms("ts").alias("ms"), F.date_format("ts", "yyyy-MM-dd").alias("run_date"))


def overlap_check(spark, d):
    from pyspark.sql.window import Window

    w = Window.partitionBy("doc_id").orderBy("chunk_index")
    c = chunk.sliding(docs(spark, d), window=400, overlap=120).withColumn("next_text", F.lead("chunk_text").over(w)).filter("next_text is not null")
    return c.select("doc_id", "chunk_index", T.overlap_matches("chunk_text", "next_text", 120).alias("same"), F.length(T.smart_join("chunk_text", "next_text")).alias("joined_chars"))


def sentence_ends(spark, d):
    return docs(spark, d).select("doc_id", chunk.last_sentence_end("text", F.lit(0), F.length("text")).alias("last_end"), chunk.last_sentence_end("text", F.lit(100), F.lit(500)).alias("end_in_window"))


def noise_filter(spark, d):
    return docs(spark, d).select("doc_id", chunk.is_noise("text").alias("noise"), T.count_chars("text", chunk.SEPARATORS).alias("separators"))


def trim_noise_edges(spark, d):
    return docs(spark, d).select("doc_id", chunk.trim_edges("text").alias("trimmed"))


def min_chars(spark, d):
    return docs(spark, d).filter(F.length("text") >= 500).select("doc_id", "n_chars")


def chunk_min_len(spark, d):
    return chunks(spark, d).filter(F.length("chunk_text") >= 250).select("doc_id", "chunk_index", F.length("chunk_text").alias("chars"))


def exact_dedup(spark, d):
    rows = dedup.require_key(docs(spark, d).withColumn("text_hash", T.sha256("text")), "text_hash")
    return dedup.keep_first(rows.select("doc_id", "text_hash", "source"), ["text_hash"], ["doc_id"])


def chunk_dedup(spark, d):
    long = chunks(spark, d).filter(F.length("chunk_text") >= 250)
    kept = dedup.keep_first(long.select("chunk_id", "doc_id", "chunk_index", "ord"), ["chunk_id"], ["ord"])
    from pyspark.sql.window import Window

    return kept.select("chunk_id", "doc_id", (F.row_number().over(Window.partitionBy("doc_id").orderBy("chunk_index")) - 1).alias("chunk_index"))


def dedup_stats(spark, d):
    return dedup.dedup_stats(docs(spark, d).select(T.sha256("text").alias("h")), "h")


def boundary_repair(spark, d):
    c = chunk.sliding(docs(spark, d), window=800, overlap=120)
    return chunk.repair_boundaries(c.select("doc_id", "chunk_index", "chunk_text"))


def paragraph_chunks(spark, d):
    return docs(spark, d).select("doc_id", F.posexplode(chunk.pack_paragraphs("text", 64)).alias("chunk_index", "chunk_text"))


def row_quarantine(spark, d):
    rows = table(spark, d, "events").select("event_id", F.when(F.col("value") > 5, F.col("event_type")).alias("key"), F.when(F.col("value") < 15, F.col("props")).otherwise(" ").alias("body"))
    good, bad = jsonl.quarantine(rows, "key", "body")
    return good.withColumn("error", F.lit("")).unionByName(bad).groupBy("error").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


def _ids(k):
    return F.array(F.lit("2"), (k % 7).cast("string"), F.lit("x"), (k % 5).cast("string"), k.cast("string"), (k % 7).cast("string"))


def ids_distinct(spark, d):
    k = F.col("event_id")
    return table(spark, d, "events").select("event_id", A.distinct_in_order(F.array(k % 3, k % 2, k % 5, F.lit(0))).alias("ids"))


def validate_ids(spark, d):
    return table(spark, d, "events").select("event_id", A.valid_ids(_ids(F.col("event_id")), 5).alias("ids"))


def _labels(policy):
    def run(spark, d):
        k = F.col("event_id").cast("int")
        inside, out = A.in_domain(F.array(F.lit(1), k % 6, k % 4), F.array(k % 5, F.lit(3), F.lit(9)), 6, policy)
        return table(spark, d, "events").select("event_id", F.array_sort(inside).alias("in_ids"), F.array_sort(out).alias("out_ids"))

    return run


def clean_queries(spark, d):
    return docs(spark, d).select("doc_id", A.clean_strings(F.split("text", "[.,\n]")).alias("parts"))


def json_props(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


def jsonl_quarantine(spark, d):
    lines = table(spark, d, "events").select(F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("["), F.col("event_id").cast("string"), F.lit("]"))).when(F.col("event_id") % 50 == 1, "{broken").when(F.col("event_id") % 50 == 2, "").otherwise(F.col("props")).alias("value"))
    path = scratch(spark, "jsonl")
    lines.write.text(path)
    good, bad = jsonl.read_jsonl(spark, path, "k int", strict=False)
    a = good.agg(F.count("*").alias("rows"), F.sum("k").alias("sum_k"))
    return a.join(F.broadcast(bad.agg(F.count("*").alias("errors"), F.max(F.length("line_preview")).alias("longest"))))  # one row each


def prompt_build(spark, d):
    b = table(spark, d, "benchmark")
    return b.select("item_id", mining.generation_prompt("text", hints=HINTS).alias("prompt"), answer.classify_prompt("text", F.array(F.col("text"), F.lit("short")), 60).alias("classify"))


def qa_validate(spark, d):
    a = F.when(F.col("doc_id") % 10 == 0, F.lit("This is NOT answerable.")).otherwise(F.col("text"))
    return docs(spark, d).select("doc_id", answer.valid_answer(a, PHRASES).alias("answer"))


def route_query(spark, d):
    return benchmark(spark, d).select("query_id", answer.route("text", ["Nicht", "the and", "shall"]).alias("r")).select("query_id", "r.use_rag", "r.confidence", "r.reason")


PARTS = s_strip("coalesce(text, '')")
S_WINDOWS = f"""
w AS (SELECT doc_id, s, {s_strip("substr(t, s + 1, 400)")} AS c FROM (SELECT doc_id, t, unnest(range(0, length(t), 280)) AS s FROM (SELECT doc_id, {PARTS} AS t FROM documents))),
c AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS INTEGER) AS chunk_index, c AS chunk_text FROM w WHERE c <> '')
"""
S_NOISY = f"""(length(p) < cap AND length(p) - length(replace(p, chr(10), '')) >= 2
  OR regexp_matches(p, '{STRONG}') OR (length(p) < cap AND regexp_matches(p, '{WEAK}')) OR (length(p) < cap AND {s_count('p', chunk.SEPARATORS)} >= 3))"""
S_END = "(?s)^(.*[.!?…。！？])"
S_IN = "list_filter([1, 2, 3, 4, 5, 6], lambda i: list_contains([1, event_id % 6, event_id % 4], i))"
S_OUT = "list_filter([1, 2, 3, 4, 5, 6], lambda i: list_contains([event_id % 5, 3, 9], i))"


def s_labels(policy: str) -> str:
    inside = f"list_filter({S_IN}, lambda i: NOT list_contains({S_OUT}, i))" if policy == "out" else S_IN
    return f"SELECT event_id, CAST(a AS INTEGER[]) AS in_ids, CAST(list_filter([1, 2, 3, 4, 5, 6], lambda i: NOT list_contains(a, i)) AS INTEGER[]) AS out_ids FROM (SELECT event_id, {inside} AS a FROM events)"


QUERIES = {
    "doc_hash": Query(doc_hash, "SELECT doc_id, sha256(text) AS text_hash FROM documents"),
    "text_sha1": Query(text_sha1, f"SELECT doc_id, sha1({s_norm('text')}) AS text_sha1 FROM documents"),
    "normalize_text": Query(normalize_text, f"SELECT doc_id, {s_norm('text')} AS normalized FROM documents"),
    "tokenize": Query(tokenize, f"SELECT doc_id, token, count(*) AS n, CAST(min(pos) AS INTEGER) AS first_pos FROM (SELECT doc_id, unnest(l) AS token, unnest(range(len(l))) AS pos FROM (SELECT doc_id, {s_tokens('text')} AS l FROM documents)) GROUP BY ALL"),
    "stem_terms": Query(stem_terms, None),
    "chunk_ids": Query(chunk_ids, f"WITH {CHUNKS} SELECT doc_id, chunk_index, chunk_id, chunk_text_hash FROM chunks"),
    "sliding_window_chunks": Query(sliding_window_chunks, f"WITH {S_WINDOWS} SELECT * FROM c"),
    "query_ids": Query(query_ids, f"WITH {ASKED} SELECT ord, query_text_norm, query_id FROM asked"),
    "query_postprocess": Query(query_postprocess, f"SELECT ord, {s_strip('left(t, 200)')} AS query_text FROM (SELECT conv_id * {TURNS} + turn AS ord, {PARTS} AS t FROM conversations WHERE role = 'user') WHERE length(t) >= 40"),
    "chunk_header": Query(chunk_header, f"SELECT doc_id, 'lang:' || lang || ', source:' || source || chr(10) || {s_strip('text')} AS chunk_text FROM documents"),
    "full_text": Query(full_text, f"SELECT doc_id, CASE WHEN t = '' THEN b ELSE t || ' ' || b END AS index_text, CASE WHEN t = '' THEN b ELSE t || chr(10) || b END AS pair_text, 'Represent the passage:' || chr(10) || b AS encoder_text FROM (SELECT doc_id, {s_strip('split_part(text, chr(10), 1)')} AS t, text AS b FROM documents)"),
    "truncate_text": Query(truncate_text, f"SELECT doc_id, CASE WHEN length(t) <= 200 THEN t ELSE {s_rstrip('left(t, 200)')} || '…' END AS short FROM (SELECT doc_id, {PARTS} AS t FROM documents)"),
    "clamp": Query(clamp, "SELECT event_id, greatest(least(value, CAST(10 AS DOUBLE)), CAST(0 AS DOUBLE)) AS clamped, CAST(0 AS DOUBLE) AS parsed FROM events"),
    "iso_time": Query(iso_time, "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, epoch_us(ts) // 1000 AS ms, strftime(ts, '%Y-%m-%d') AS run_date FROM events"),
    "overlap_check": Query(overlap_check, f"WITH {S_WINDOWS} SELECT doc_id, chunk_index, length(a) >= 120 AND length(b) >= 120 AND right(a, 120) = left(b, 120) AS same, CAST(length(a) + 1 + length(b) AS INTEGER) AS joined_chars FROM (SELECT doc_id, chunk_index, chunk_text AS a, lead(chunk_text) OVER (PARTITION BY doc_id ORDER BY chunk_index) AS b FROM c) WHERE b IS NOT NULL"),
    "sentence_ends": Query(sentence_ends, f"SELECT doc_id, CAST(nullif(length(regexp_extract(text, '{S_END}(?:[ \\n\\t\\r]|$)', 1)), 0) - 1 AS INTEGER) AS last_end, CAST(99 + nullif(length(regexp_extract(substr(text, 101, 401), '{S_END}' || CASE WHEN length(text) > 500 THEN '[ \\n\\t\\r]' ELSE '(?:[ \\n\\t\\r]|$)' END, 1)), 0) AS INTEGER) AS end_in_window FROM documents"),
    "noise_filter": Query(noise_filter, f"""SELECT doc_id, CASE WHEN t = '' OR length(t) < 200 THEN true WHEN length(t) < 250 AND {s_count('t', chunk.SEPARATORS)} >= 4 THEN true
        WHEN length(t) < 600 AND regexp_matches(t, '{STRONG}') THEN true WHEN length(t) < 250 AND regexp_matches(t, '{WEAK}') THEN true ELSE false END AS noise, CAST({s_count('text', chunk.SEPARATORS)} AS INTEGER) AS separators
        FROM (SELECT doc_id, text, {PARTS} AS t FROM documents)"""),
    "trim_noise_edges": Query(trim_noise_edges, f"""WITH a AS (SELECT doc_id, {PARTS} AS t FROM documents), b AS (SELECT doc_id, least(120, CAST(floor(length(t) * CAST(0.35 AS DOUBLE)) AS INTEGER)) AS cap,
        list_filter(list_transform(string_split_regex(t, '{chunk.EDGE_RE}'), lambda p: {s_strip('p')}), lambda p: p <> '') AS parts FROM a),
        e AS (SELECT doc_id, cap, unnest(parts) AS p, unnest(range(len(parts))) AS i FROM b), f AS (SELECT doc_id, min(i) AS lo, max(i) AS hi FROM e WHERE NOT {S_NOISY} GROUP BY ALL)
        SELECT doc_id, coalesce(array_to_string(parts[lo + 1 : hi + 1], chr(10) || chr(10)), '') AS trimmed FROM b LEFT JOIN f USING (doc_id)"""),
    "min_chars": Query(min_chars, "SELECT doc_id, n_chars FROM documents WHERE length(text) >= 500"),
    "chunk_min_len": Query(chunk_min_len, f"WITH {CHUNKS} SELECT doc_id, chunk_index, CAST(length(chunk_text) AS INTEGER) AS chars FROM chunks WHERE length(chunk_text) >= 250"),
    "exact_dedup": Query(exact_dedup, "SELECT doc_id, text_hash, source FROM (SELECT doc_id, sha256(text) AS text_hash, source, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r = 1"),
    "chunk_dedup": Query(chunk_dedup, f"WITH {CHUNKS}, k AS (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY ord) AS r FROM placed WHERE length(chunk_text) >= 250) SELECT chunk_id, doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY chunk_index) - 1 AS INTEGER) AS chunk_index FROM k WHERE r = 1"),
    "dedup_stats": Query(dedup_stats, "SELECT count(*) AS total, count(DISTINCT text) AS kept, count(*) - count(DISTINCT text) AS removed FROM documents"),
    "boundary_repair": Query(boundary_repair, None),
    "paragraph_chunks": Query(paragraph_chunks, None),
    "row_quarantine": Query(row_quarantine, "SELECT CASE WHEN value <= 5 THEN 'missing key' WHEN value >= 15 THEN 'blank text' ELSE '' END AS error, count(*) AS n, min(event_id) AS first_id FROM events GROUP BY 1"),
    "ids_distinct": Query(ids_distinct, "SELECT event_id, list_transform(list_filter(range(4), lambda i: list_position(l, l[i + 1]) = i + 1), lambda i: l[i + 1]) AS ids FROM (SELECT event_id, [event_id % 3, event_id % 2, event_id % 5, 0] AS l FROM events)"),
    "validate_ids": Query(validate_ids, "SELECT event_id, list_sort(list_distinct(list_filter([2, CAST(event_id % 7 AS INTEGER), CAST(event_id % 5 AS INTEGER), CAST(event_id AS INTEGER)], lambda x: x >= 0 AND x < 5))) AS ids FROM events"),
    "domain_labels": Query(_labels("out"), s_labels("out")),
    "domain_labels_in_wins": Query(_labels("in"), s_labels("in")),
    "clean_queries": Query(clean_queries, f"WITH p AS (SELECT doc_id, list_filter(list_transform(string_split_regex(text, '[.,\\n]'), lambda x: {s_strip('x')}), lambda x: x <> '') AS l FROM documents), e AS (SELECT doc_id, unnest(l) AS x, unnest(range(len(l))) AS i FROM p), f AS (SELECT doc_id, x, min(i) AS i FROM e GROUP BY ALL) SELECT doc_id, coalesce(parts, []) AS parts FROM p LEFT JOIN (SELECT doc_id, list(x ORDER BY i) AS parts FROM f GROUP BY ALL) USING (doc_id)"),
    "json_props": Query(json_props, "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events"),
    "jsonl_quarantine": Query(jsonl_quarantine, "SELECT count(*) FILTER (event_id % 50 > 2) AS rows, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) FILTER (event_id % 50 > 2) AS BIGINT) AS sum_k, count(*) FILTER (event_id % 50 < 2) AS errors, CAST(max(CASE WHEN event_id % 50 = 0 THEN length(CAST(event_id AS VARCHAR)) + 2 ELSE 7 END) FILTER (event_id % 50 < 2) AS INTEGER) AS longest FROM events"),
    "prompt_build": Query(prompt_build, f"""SELECT item_id, 'Read the text below and write 3 information-seeking search queries that it answers, one on each line.' || chr(10) || 'Let them differ in these ways:' || chr(10) || '{HINTS}' || chr(10) || chr(10) || 'Text:' || chr(10) || text AS prompt,
        'Query:' || chr(10) || f || chr(10) || chr(10) || 'Documents:' || chr(10) || '0: ' || CASE WHEN length(f) > 60 THEN left(f, 60) || '...' ELSE f END || chr(10) || '1: short' AS classify
        FROM (SELECT item_id, text, replace({PARTS}, chr(10), ' ') AS f FROM benchmark)"""),
    "qa_validate": Query(qa_validate, f"SELECT doc_id, CASE WHEN doc_id % 10 = 0 OR contains(lower(t), 'not answerable') OR contains(lower(t), 'cannot be answered') THEN '' WHEN length(t) > 900 THEN {s_rstrip('left(t, 900)')} ELSE t END AS answer FROM (SELECT doc_id, {PARTS} AS t FROM documents)"),
    "route_query": Query(route_query, f"SELECT item_id AS query_id, k AS use_rag, CASE WHEN t = '' THEN CAST(0 AS DOUBLE) WHEN k THEN CAST(0.99 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS confidence, CASE WHEN t = '' THEN 'empty query' WHEN k THEN 'keyword' ELSE 'no keyword' END AS reason FROM (SELECT item_id, {PARTS} AS t, contains(lower(text), 'nicht') OR contains(lower(text), 'the and') OR contains(lower(text), 'shall') AS k FROM benchmark)"),
}
