"""Queries over mined queries, packs, training rows, contexts and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import vectors as V
from textloom.operators import answer, dedup, mining, retrieve, rows, stages, training
from textloom.plans.common import TURNS, CHUNK_PLACES, ASKED, BM25, CHUNKS, WS, Query, asked, benchmark, chunks, s_norm, s_rstrip, s_strip, s_tokens, scratch, table
from textloom.operators.lineage import stored
from textloom.plans.search import answers, found_bm25, found_documents
from textloom.streaming import generation, incremental

KEYWORDS = ["the", "of"]


def sample_chunks(spark, d):
    return mining.sample(chunks(spark, d).select("chunk_id", "ord"), 300)


def sample_per_doc(spark, d):
    return mining.sample_per_document(chunks(spark, d).select("chunk_id", "doc_id", "chunk_index"), 2)


def incremental_chunks(spark, d):
    all_ = chunks(spark, d).select("chunk_id", "ord")
    return incremental.append_new(all_, all_.filter(f"ord % {3 * CHUNK_PLACES} = 0"), "chunk_id")


def embedding_id_map(spark, d):
    """The id map of all chunks' vectors, as the embedding stage writes it beside the index."""
    path = scratch(spark, "embedded")
    stages.embed_chunks(chunks(spark, d).select("chunk_id", "chunk_text", "ord"), path)
    return spark.read.schema("id long, chunk_id string").json(f"{path}/id_map")


def query_batches(spark, d):
    q = asked(spark, d).select("ord", "query_id")
    return mining.batched(q, 15, ["ord"]).select("ord", "query_id", "n", F.col("batch").cast("long").alias("batch"))


def _marked(spark, d):
    q = mining.batched(asked(spark, d), 15, ["ord"])
    return q.withColumn("in_domain", mining.keyword_domain(F.col("text"), KEYWORDS))


def target_stop(spark, d):
    return mining.until_target(_marked(spark, d), 60, 5).select("ord", "query_id", "in_domain")


def resume_queries(spark, d):
    q = asked(spark, d).select("query_id", "ord")
    return q.join(q.filter(F.col("ord") < 30 * TURNS).select("query_id").distinct(), "query_id", "left_anti")


def query_generation(spark, d):
    c = chunks(spark, d).select("chunk_id", "chunk_text", "ord")
    previous = asked(spark, d).select("query_id", F.lit("in").alias("domain")).limit(0)
    return mining.query_run(c, previous, target=40, cap=500, n=2).select("query_id", "query_text_norm", F.get("source_chunk_ids", F.lit(0)).alias("chunk_id"), "domain", F.col("batch").cast("long").alias("batch"))


def query_generation_stream(spark, d):
    """The same as a stream over parts of the sample, with its state in a checkpoint."""
    base = scratch(spark, "generation")
    generation.write_parts(chunks(spark, d), f"{base}/parts", cap=500, size=100)
    out = generation.run(spark, f"{base}/parts", f"{base}/out", f"{base}/state", 40, n=2)
    return out.select("query_id", "query_text_norm", F.get("source_chunk_ids", F.lit(0)).alias("chunk_id"), "domain", "batch")


def _queries(spark, d):
    """Benchmark texts as queries with the document of their best match as source."""
    best = answers(spark, d, 10)
    return best, best.filter("rank = 1").join(benchmark(spark, d), "query_id").select(F.col("query_id").cast("string").alias("query_id"), F.col("text").alias("query_text_norm"), F.array(F.col("doc_key").cast("string"), F.lit("none")).alias("source_chunk_ids"))


def _documents(spark, d, found):
    """The documents that a stored search found, as chunks."""
    return found_documents(spark, d, found).select(F.col("doc_id").cast("string").alias("chunk_id"), F.col("text").alias("chunk_text"), F.col("doc_id").alias("ord"))


def source_chunk_lookup(spark, d):
    """The source of every benchmark text, looked up among the documents; a text that matches none has none."""
    best = answers(spark, d, 10)
    source = best.filter("rank = 1").select("query_id", F.array(F.col("doc_key").cast("string"), F.lit("none")).alias("source_chunk_ids"))
    q = benchmark(spark, d).select("query_id").join(source, "query_id", "left").withColumn("query_id", F.col("query_id").cast("string"))
    good, bad = mining.source_chunks(q, _documents(spark, d, best))
    return good.select("query_id", "chunk_id", F.lit(True).alias("found")).unionByName(bad.select("query_id", "chunk_id", F.lit(False).alias("found")))


def grounded_sources(spark, d):
    found = answers(spark, d, 4)
    best = found.groupBy(F.col("query_id").cast("string").alias("query_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "doc_key"))), lambda x: x["doc_key"].cast("string")).alias("source_chunk_ids"))
    return mining.grounded_sources(best, _documents(spark, d, found), "concat")


def query_packs(spark, d):
    best, q = _queries(spark, d)
    found = best.select(F.col("query_id").cast("string").alias("query_id"), F.col("doc_key").cast("string").alias("doc_key"), "rank")
    return mining.packs(q, _documents(spark, d, best), found, 0.97)


def simple_packs(spark, d):
    """Packs of ranks: the first two are positives, the others negatives; every fifth query has no negatives."""
    best = answers(spark, d, 10).select(F.col("query_id").cast("string").alias("query_id"), F.col("doc_key").cast("string").alias("k"), "rank", (F.col("query_id") % 5 == 0).alias("bare"))
    lists = lambda on: F.transform(F.array_sort(F.collect_list(F.when(on, F.struct("rank", "k")))), lambda x: x["k"])
    return best.groupBy("query_id").agg(F.min(F.struct("rank", "k"))["k"].alias("source_id"), lists(F.col("rank") <= 2).alias("positives"), lists((F.col("rank") > 2) & ~F.col("bare")).alias("negatives"))


def pack_lists(spark, d):
    return simple_packs(spark, d)


def train_valid_split(spark, d):
    c = table(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("query_id"), "turn")
    return training.split(c)


def split_counts(spark, d):
    return training.split_counts(train_valid_split(spark, d))


def _pool(spark, d):
    """All documents by number, stored: each kind of draw reads them twice."""
    return stored(mining.numbered(table(spark, d, "documents").select("doc_id"), ["doc_id"]).select("n", F.col("doc_id").cast("string").alias("chunk_id")), "pool")


def epoch_pairs(spark, d):
    return training.epoch_pairs(simple_packs(spark, d), _pool(spark, d), 1)


def random_negatives(spark, d):
    packs = stored(simple_packs(spark, d), "packs")
    needs = packs.select(F.concat("query_id", F.lit("-r")).alias("draw"), "query_id")
    banned = packs.select("query_id", F.explode(F.concat("positives", "negatives")).alias("chunk_id"))
    return training.random_chunks(needs, _pool(spark, d), banned, 7)


def cap_negatives(spark, d):
    return training.eval_packs(simple_packs(spark, d), 3)


def pairwise_loss(spark, d):
    s = found_bm25(spark, d, 2).groupBy("query_id").agg(F.max(F.when(F.col("rank") == 1, F.col("score"))).alias("p"), F.max(F.when(F.col("rank") == 2, F.col("score"))).alias("n"))
    e = table(spark, d, "events").select(F.col("value").alias("p"), (F.col("event_id") % 13).cast("double").alias("n"))
    both = s.select("p", "n").dropna().unionByName(e)
    return both.agg(F.round(F.avg(training.pairwise_loss(F.col("p"), F.col("n"))), 6).alias("logistic"), F.round(F.avg(training.margin_loss(F.col("p"), F.col("n"))), 6).alias("margin"))


def context_block(spark, d):
    found = answers(spark, d, 4)
    best = found.join(found_documents(spark, d, found).select(F.col("doc_id").alias("doc_key"), "text"), "doc_key")
    lists = best.groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda x: x["text"]).alias("docs"))
    return lists.select("query_id", answer.context(F.col("docs"), 3, 400).alias("context"))


def _found_texts(spark, d):
    best = answers(spark, d, 3)
    return stored(best.join(found_documents(spark, d, best).select(F.col("doc_id").alias("doc_key"), F.col("text").alias("chunk_text")), "doc_key"), "found-texts")  # read by several branches


def _answers(spark, d):
    return answer.answer_chain(benchmark(spark, d), _found_texts(spark, d), ["the", "de"], 2, 400)


def answer_chain(spark, d):
    return _answers(spark, d)


def judge_summary(spark, d):
    rag = _answers(spark, d).select("query_id", "mode", "answer").join(benchmark(spark, d), "query_id").select(F.col("mode").alias("system"), answer.judge(F.col("answer"), F.col("text")).alias("score"))
    rows = rag.withColumn("is_correct", F.col("score") >= 0.1)
    return answer.judge_summary(rows).select("system", "n", F.round("accuracy", 6).alias("accuracy"), F.round("mean_score", 6).alias("mean_score"))


def direct_vs_rag(spark, d):
    rows = answer.direct_versus_rag(benchmark(spark, d).withColumn("gold", F.col("text")), _found_texts(spark, d), 2, 400, least=0.1)
    return rows.select("query_id", "system", "answer", F.round("score", 6).alias("score"), "is_correct")


def judge_table(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("system"), (F.col("value") > 4).alias("is_correct"), (F.col("value") / 10).alias("score"))
    return answer.judge_summary(e).select("system", "n", F.round("accuracy", 6).alias("accuracy"), F.round("mean_score", 6).alias("mean_score"))


def qa_dataset(spark, d):
    best, q = _queries(spark, d)
    g = mining.grounded_sources(q.select("query_id", "source_chunk_ids"), _documents(spark, d, best))
    return answer.qa_rows(q.select("query_id", F.col("query_text_norm").alias("query_text")), g, ["not answerable"])


def event_windows(spark, d):
    e = table(spark, d, "events").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return e.select(F.col("window.start").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


def stream_new_chunks(spark, d):
    """The same by Structured Streaming: each event type and user once, from a file stream run to its end."""
    base = scratch(spark, "stream")
    source = table(spark, d, "events")
    source.repartition(4).write.parquet(f"{base}/in")
    stream = incremental.table_stream(spark, f"{base}/in", source.schema, 2).select(F.concat_ws("-", "event_type", F.col("user_id").cast("string")).alias("key"))
    incremental.run_to_end(incremental.new_once(stream, "key"), f"{base}/out", f"{base}/state")
    return spark.read.schema("key string").parquet(f"{base}/out")


def epoch_shuffle(spark, d):
    return rows.shuffled(table(spark, d, "labels").select("doc_id", "toxic"), "doc_id", 42, 2)


def pair_texts(spark, d):
    pairs = epoch_pairs(spark, d).join(benchmark(spark, d).select(F.col("query_id").cast("string").alias("query_id"), F.col("text").alias("query_text")), "query_id")
    pairs = stored(pairs, "pairs")
    wanted = pairs.select(F.explode(F.array("positive", "negative")).alias("chunk_id"))
    documents = retrieve.only(table(spark, d, "documents").withColumn("chunk_id", F.col("doc_id").cast("string")), wanted, "chunk_id").select("chunk_id", F.col("source").alias("title"), F.col("text").alias("chunk_text"))
    return rows.pair_texts(pairs, documents).select("query_text", "positive_text", "negative_text", "type")


def prune_removed(spark, d):
    gone = table(spark, d, "labels").filter("toxic = 1").select("doc_id")
    return rows.prune(table(spark, d, "documents").select("doc_id", "source"), gone, "doc_id")


def structure_length(spark, d):
    json = F.to_json(F.struct(F.array(F.struct(F.array(F.struct(F.col("text").alias("text")), F.struct(F.col("lang").alias("text"))).alias("blocks"))).alias("pages")))
    return table(spark, d, "documents").select("doc_id", rows.structure_chars(json).alias("chars"))


def coerce_rows(spark, d):
    made = table(spark, d, "documents").select(F.col("doc_id").alias("chunk_id"), F.when(F.col("doc_id") % 3 > 0, F.col("text")).alias("chunk_text"), F.col("lang").alias("chunk_index"), "source")
    return rows.coerce_chunks(made).select("chunk_id", "chunk_index", "chunk_text_hash", "source", "url")


def merge_queries_semantic(spark, d):
    """User turns of two files: those of the second that are in the first go, exactly, then by meaning."""
    q = asked(spark, d).select("query_id", "text", F.col("ord").alias("id"))
    return dedup.query_dedup(dedup.merge_exact(q.filter(F.col("id") < 50 * TURNS), q.filter(F.col("id") >= 50 * TURNS)).select("id", "text"), 20, 0.9)


def search_hits(spark, d):
    found = answers(spark, d, 5)
    return retrieve.hits(found, found_documents(spark, d, found), "doc_id", "text").select("query_id", "doc_key", "rank", F.length("chunk_text").alias("chars"))


def model_score(spark, d):
    e = table(spark, d, "events")
    logits = F.when(F.col("event_id") % 2 == 0, F.array("value")).otherwise(F.array(F.lit(0.0), "value"))
    return e.select("event_id", V.last_logit(logits).alias("score"))


def learned_reranker(spark, d):
    """Training a linear reranker on pairs of two features, and its scores of the pairs' positives."""
    best = answers(spark, d, 10)
    found = best.join(benchmark(spark, d).withColumnRenamed("text", "q"), "query_id").join(found_documents(spark, d, best).select(F.col("doc_id").alias("doc_key"), "text"), "doc_key")
    features = stored(found.select("query_id", "rank", F.array(F.col("score") / 100, retrieve.overlap_score(F.col("q"), F.col("text"))).alias("f")), "features")  # every step of the training reads them
    pairs = features.filter("rank = 1").select("query_id", F.col("f").alias("pos_features")).join(features.filter("rank > 3").select("query_id", F.col("f").alias("neg_features")), "query_id")
    model = training.train_reranker(pairs)
    return pairs.select("query_id", (training.rerank_score(model, F.col("pos_features")) > training.rerank_score(model, F.col("neg_features"))).alias("right")).groupBy("query_id").agg(F.avg(F.col("right").cast("double")).alias("accuracy"))


DOCS = "docs AS (SELECT CAST(doc_id AS VARCHAR) AS chunk_id, text AS chunk_text, doc_id AS ord FROM documents)"
NUMBERED = "numbered AS (SELECT *, row_number() OVER (ORDER BY ord) - 1 AS n FROM asked)"
SIMPLE = f"""{BM25}, best AS (SELECT CAST(query_id AS VARCHAR) AS query_id, CAST(doc_key AS VARCHAR) AS k, rank, query_id % 5 = 0 AS bare FROM bm25 WHERE rank <= 10),
packs AS (SELECT query_id, arg_min(k, rank) AS source_id, coalesce(list(k ORDER BY rank) FILTER (rank <= 2), []) AS positives, coalesce(list(k ORDER BY rank) FILTER (rank > 2 AND NOT bare), []) AS negatives FROM best GROUP BY query_id)"""
POOL = "pool AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS n, CAST(doc_id AS VARCHAR) AS chunk_id FROM documents)"
SPLIT = "ids AS (SELECT DISTINCT CAST(conv_id AS VARCHAR) AS query_id FROM conversations), cut AS (SELECT greatest(CAST(round_even(count(*) * (CAST(1 AS DOUBLE) - CAST(0.85 AS DOUBLE)), 0) AS BIGINT), 1) AS v FROM ids), valid AS (SELECT query_id FROM (SELECT query_id, row_number() OVER (ORDER BY sha256('42:' || query_id)) AS r FROM ids), cut WHERE r <= v), parted AS (SELECT CAST(conv_id AS VARCHAR) AS query_id, turn, CASE WHEN CAST(conv_id AS VARCHAR) IN (SELECT query_id FROM valid) THEN 'valid' ELSE 'train' END AS split FROM conversations)"


def s_draws(needs: str, banned: str, seed: int) -> str:
    start = f"('0x' || left(sha256('{seed}:' || draw), 15))::BIGINT % (s - len(b))"
    lists = f"SELECT query_id, list(n ORDER BY n) AS b FROM (SELECT DISTINCT query_id, chunk_id FROM {banned}) JOIN pool USING (chunk_id) GROUP BY query_id"
    return f"""SELECT draw, query_id, chunk_id FROM (
        SELECT draw, query_id, list_reduce(list_prepend({start}, b), lambda n, x: n + CASE WHEN x <= n THEN 1 ELSE 0 END) AS n
        FROM (SELECT draw, query_id, coalesce(b, []) AS b, (SELECT count(*) FROM pool) AS s FROM {needs} LEFT JOIN ({lists}) USING (query_id)) WHERE s > len(b)) JOIN pool USING (n)"""


def s_context(limit: int) -> str:
    return f"""c AS (SELECT query_id, rank, {s_strip('d.text')} AS t FROM bm25 JOIN documents d ON d.doc_id = doc_key WHERE rank <= 3),
    walk AS (SELECT DISTINCT query_id, CAST(0 AS INTEGER) AS rank, CAST(0 AS BIGINT) AS used, CAST([] AS VARCHAR[]) AS parts FROM c UNION ALL
      SELECT query_id, rank, CASE WHEN left_ <= 0 THEN used ELSE used + length(piece) END, CASE WHEN left_ <= 0 THEN parts ELSE list_append(parts, piece) END FROM (
        SELECT w.query_id, c.rank, w.used, w.parts, {limit} - w.used AS left_, 'Document:' || chr(10) || CASE WHEN length(c.t) <= greatest(0, {limit} - w.used - 10) THEN c.t ELSE {s_rstrip(f'left(c.t, greatest(0, {limit} - w.used - 10))')} || '…' END || chr(10) AS piece
        FROM walk w JOIN c ON c.query_id = w.query_id AND c.rank = w.rank + 1))"""


F1 = f"(SELECT query_id, {{0}} AS system, answer, 2 * CAST(len(list_intersect(list_distinct({s_tokens('answer')}), list_distinct({s_tokens('text')}))) AS DOUBLE) / nullif(len(list_distinct({s_tokens('answer')})) + len(list_distinct({s_tokens('text')})), 0) AS f, {s_strip('text')} AS q FROM {{1}} JOIN benchmark ON item_id = query_id)"
ANSWERS = f"""{BM25},
    hit AS (SELECT query_id, rank, d.text AS t, round(coalesce(CAST(len(list_intersect(list_distinct({s_tokens('b.text')}), {s_tokens('d.text')})) AS DOUBLE) / nullif(len(list_distinct({s_tokens('b.text')})), 0), 0), 6) AS s
      FROM bm25 JOIN benchmark b ON b.item_id = query_id JOIN documents d ON d.doc_id = doc_key WHERE rank <= 3),
    lead AS (SELECT query_id, first({s_strip('t')} ORDER BY s DESC, rank) AS t FROM hit GROUP BY query_id),
    grounded AS (SELECT item_id AS query_id, coalesce({s_strip("split_part(regexp_replace(t, '[.!?]', chr(10), 'g'), chr(10), 1)")}, '') AS answer FROM benchmark LEFT JOIN lead ON query_id = item_id),
    echoed AS (SELECT item_id AS query_id, {s_strip("coalesce(text, '')")} AS answer FROM benchmark),
    judged AS (SELECT query_id, system, answer, coalesce(f, 0) AS score, contains(lower(q), 'the') OR contains(lower(q), 'de') AS routed FROM (FROM {F1.format("'rag'", 'grounded')} UNION ALL FROM {F1.format("'direct'", 'echoed')}))"""
HARD = "list_sort(list_transform(negatives, lambda x: {'r': sha256('43:' || query_id || ':' || i || ':' || x), 'n': x}))"
PAIRS = f"""WITH {SIMPLE}, {POOL}, e AS (SELECT query_id, source_id, positives, negatives, unnest(positives) AS positive, unnest(range(len(positives))) AS i FROM packs),
        h AS (SELECT query_id, positive, i, len(negatives) AS m, CASE WHEN len(negatives) = 0 THEN [] WHEN len(negatives) < len(positives) THEN list_transform({HARD}, lambda x: x.n)[1:1] ELSE list_transform({HARD}, lambda x: x.n)[1:len(negatives) // len(positives)] END AS l FROM e),
        strict_ AS (SELECT query_id, unnest(list_concat([source_id], positives, negatives)) AS chunk_id FROM packs), own AS (SELECT query_id, unnest(positives) AS chunk_id FROM packs),
        needs AS (SELECT query_id, positive, query_id || ':' || i || ':0' AS draw FROM h WHERE m > 0), bare AS (SELECT query_id, positive, query_id || ':' || i || ':f' AS draw FROM h WHERE m = 0),
        r AS ({s_draws('needs', 'strict_', 43)}), f AS ({s_draws('bare', 'own', 43)})"""
PAIR_ROWS = """SELECT query_id, positive, unnest(l) AS negative, 'hard_negative' AS type, 1 AS epoch FROM h UNION ALL
        SELECT query_id, positive, chunk_id, 'random_negative', 1 FROM needs JOIN r USING (draw, query_id) UNION ALL SELECT query_id, positive, chunk_id, 'random_negative_fallback', 1 FROM bare JOIN f USING (draw, query_id)"""
GENERATED = f"""WITH {CHUNKS}, picked AS (SELECT chunk_id, chunk_text, ord FROM placed ORDER BY sha256('42:' || chunk_id), chunk_id LIMIT 500),
        parts AS (SELECT *, list_filter(list_transform(string_split_regex(left(chunk_text, 2100), '[.!?\\n]+'), lambda x: {s_strip('x')}), lambda x: x <> '')[1:2] AS l FROM picked),
        each AS (SELECT chunk_id, ord, unnest(l) AS q, unnest(range(len(l))) AS place FROM parts), fit AS (SELECT *, {s_norm(s_strip('left(q, 160)'))} AS t FROM each WHERE length(q) >= 12),
        named AS (SELECT left(sha256(t), 24) AS query_id, t, min({{'o': ord, 'p': place, 'c': chunk_id}}) AS r FROM fit WHERE t <> '' GROUP BY ALL),
        placed_ AS (SELECT *, (row_number() OVER (ORDER BY r.o, r.p, query_id) - 1) // 15 AS b, list_has_any({s_tokens('t')}, ['the', 'and', 'with']) AS ok FROM named),
        s AS (SELECT b, coalesce(sum(h) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT b, count(*) FILTER (ok) AS h FROM placed_ GROUP BY b))
        SELECT query_id, t AS query_text_norm, r.c AS chunk_id, CASE WHEN ok THEN 'in' ELSE 'out' END AS domain, b AS batch FROM placed_ JOIN s USING (b) WHERE before < 40"""
QUERIES = {
    "sample_chunks": Query(sample_chunks, f"WITH {CHUNKS} SELECT chunk_id, ord FROM placed ORDER BY sha256('42:' || chunk_id), chunk_id LIMIT 300"),
    "sample_per_doc": Query(sample_per_doc, f"WITH {CHUNKS} SELECT chunk_id, doc_id, chunk_index FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sha256('42:' || chunk_id), chunk_id) AS r FROM chunks) WHERE r <= 2"),
    "incremental_chunks": Query(incremental_chunks, f"WITH {CHUNKS} SELECT chunk_id, min(ord) AS ord FROM placed WHERE chunk_id NOT IN (SELECT chunk_id FROM placed WHERE ord % {3 * CHUNK_PLACES} = 0) GROUP BY chunk_id"),
    "embedding_id_map": Query(embedding_id_map, f"WITH {CHUNKS} SELECT row_number() OVER (ORDER BY ord) - 1 AS id, chunk_id FROM placed"),
    "query_batches": Query(query_batches, f"WITH {ASKED}, {NUMBERED} SELECT ord, query_id, n, n // 15 AS batch FROM numbered"),
    "target_stop": Query(target_stop, f"WITH {ASKED}, {NUMBERED}, m AS (SELECT *, n // 15 AS b, list_has_any({s_tokens('text')}, ['the', 'of']) AS in_domain FROM numbered), s AS (SELECT b, 5 + coalesce(sum(h) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT b, count(*) FILTER (in_domain) AS h FROM m GROUP BY b)) SELECT ord, query_id, in_domain FROM m JOIN s USING (b) WHERE before < 60"),
    "resume_queries": Query(resume_queries, f"WITH {ASKED} SELECT query_id, ord FROM asked WHERE query_id NOT IN (SELECT query_id FROM asked WHERE ord < {30 * TURNS})"),
    "query_generation": Query(query_generation, GENERATED),
    "query_generation_stream": Query(query_generation_stream, GENERATED),
    "source_chunk_lookup": Query(source_chunk_lookup, f"WITH {BM25} SELECT CAST(item_id AS VARCHAR) AS query_id, CAST(doc_key AS VARCHAR) AS chunk_id, doc_id IS NOT NULL AS found FROM benchmark LEFT JOIN (FROM bm25 WHERE rank = 1) ON query_id = item_id LEFT JOIN documents ON doc_id = doc_key"),
    "grounded_sources": Query(grounded_sources, f"WITH {BM25} SELECT CAST(query_id AS VARCHAR) AS query_id, list(CAST(doc_key AS VARCHAR) ORDER BY rank) AS used_ids, string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS chunk_text FROM bm25 JOIN documents ON doc_id = doc_key WHERE rank <= 3 GROUP BY query_id"),
    "query_packs": Query(query_packs, None),
    "pack_lists": Query(pack_lists, f"WITH {SIMPLE} SELECT * FROM packs"),
    "train_valid_split": Query(train_valid_split, f"WITH {SPLIT} SELECT * FROM parted"),
    "split_counts": Query(split_counts, f"WITH {SPLIT} SELECT count(DISTINCT query_id) AS total_ids, count(DISTINCT query_id) FILTER (split = 'train') AS train_ids, count(DISTINCT query_id) FILTER (split = 'valid') AS valid_ids FROM parted"),
    "epoch_pairs": Query(epoch_pairs, f"{PAIRS} {PAIR_ROWS}"),
    "random_negatives": Query(random_negatives, f"WITH {SIMPLE}, {POOL}, needs AS (SELECT query_id || '-r' AS draw, query_id FROM packs), banned AS (SELECT query_id, unnest(list_concat(positives, negatives)) AS chunk_id FROM packs) {s_draws('needs', 'banned', 7)}"),
    "cap_negatives": Query(cap_negatives, f"WITH {SIMPLE}, c AS (SELECT query_id, positives, list_transform(list_sort(list_transform(negatives, lambda x: {{'r': sha256('42:' || query_id || ':' || x), 'n': x}})), lambda x: x.n)[1:3] AS few FROM packs) SELECT query_id, list_concat(positives, few) AS doc_ids, CAST(list_concat(list_transform(positives, lambda x: 1), list_transform(few, lambda x: 0)) AS INTEGER[]) AS labels FROM c"),
    "pairwise_loss": Query(pairwise_loss, f"WITH {BM25}, s AS (SELECT max(score) FILTER (rank = 1) AS p, max(score) FILTER (rank = 2) AS n FROM bm25 GROUP BY query_id), b AS (SELECT p - n AS d FROM s WHERE n IS NOT NULL UNION ALL SELECT value - CAST(event_id % 13 AS DOUBLE) FROM events) SELECT round(avg(greatest(-d, 0) + ln(1 + exp(-abs(d)))), 6) AS logistic, round(avg(greatest(0, 1 - d)), 6) AS margin FROM b"),
    "context_block": Query(context_block, f"WITH RECURSIVE {BM25}, {s_context(1280)} SELECT query_id, {s_strip('array_to_string(arg_max(parts, rank), chr(10))')} AS context FROM walk GROUP BY query_id"),
    "answer_chain": Query(answer_chain, None),
    "judge_summary": Query(judge_summary, f"WITH {ANSWERS} SELECT system, count(*) AS n, round(avg(CAST(score >= 0.1 AS INTEGER)), 6) AS accuracy, round(avg(score), 6) AS mean_score FROM judged WHERE routed = (system = 'rag') GROUP BY system"),
    "direct_vs_rag": Query(direct_vs_rag, f"WITH {ANSWERS} SELECT query_id, system, answer, round(score, 6) AS score, score >= 0.1 AS is_correct FROM judged"),
    "judge_table": Query(judge_table, "SELECT event_type AS system, count(*) AS n, round(avg(CAST(value > 4 AS INTEGER)), 6) AS accuracy, round(avg(greatest(least(value / 10, 1), 0)), 6) AS mean_score FROM events GROUP BY event_type"),
    "qa_dataset": Query(qa_dataset, f"WITH {BM25}, q AS (SELECT CAST(query_id AS VARCHAR) AS query_id, {s_strip('b.text')} AS question, {s_strip(f'''split_part(regexp_replace({s_strip('d.text')}, '[.!?]', chr(10), 'g'), chr(10), 1)''')} AS a, [CAST(doc_key AS VARCHAR)] AS used_ids FROM bm25 JOIN benchmark b ON b.item_id = query_id JOIN documents d ON d.doc_id = doc_key WHERE rank = 1) SELECT query_id, question, CASE WHEN length(a) > 900 THEN {s_rstrip('left(a, 900)')} ELSE a END AS answer, used_ids FROM q WHERE a <> '' AND NOT contains(lower(a), 'not answerable')"),
    "epoch_shuffle": Query(epoch_shuffle, "SELECT doc_id, toxic, sha256('42002:' || doc_id) AS shuffle_key FROM labels"),
    "pair_texts": Query(pair_texts, f"{PAIRS}, pairs AS ({PAIR_ROWS}), titled AS (SELECT CAST(doc_id AS VARCHAR) AS chunk_id, CASE WHEN title = '' THEN text ELSE title || chr(10) || text END AS t FROM (SELECT doc_id, {s_strip("coalesce(source, '')")} AS title, coalesce(text, '') AS text FROM documents)) SELECT b.text AS query_text, p.t AS positive_text, n.t AS negative_text, type FROM pairs JOIN benchmark b ON CAST(b.item_id AS VARCHAR) = query_id JOIN titled p ON p.chunk_id = positive JOIN titled n ON n.chunk_id = negative"),
    "prune_removed": Query(prune_removed, "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)"),
    "structure_length": Query(structure_length, "SELECT doc_id, CAST(length(text) + length(lang) AS INTEGER) AS chars FROM documents"),
    "coerce_rows": Query(coerce_rows, f"SELECT CAST(doc_id AS VARCHAR) AS chunk_id, CAST(0 AS INTEGER) AS chunk_index, sha1(CASE WHEN doc_id % 3 > 0 THEN {s_norm('text')} ELSE '' END) AS chunk_text_hash, source, CAST(NULL AS VARCHAR) AS url FROM documents"),
    "merge_queries_semantic": Query(merge_queries_semantic, None),
    "search_hits": Query(search_hits, f"WITH {BM25} SELECT query_id, doc_key, rank, CAST(length(text) AS INTEGER) AS chars FROM bm25 JOIN documents ON doc_id = doc_key WHERE rank <= 5"),
    "model_score": Query(model_score, "SELECT event_id, value AS score FROM events"),
    "learned_reranker": Query(learned_reranker, None),
    "event_windows": Query(event_windows, "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL"),
    "stream_new_chunks": Query(stream_new_chunks, "SELECT DISTINCT event_type || '-' || user_id AS key FROM events"),
}
