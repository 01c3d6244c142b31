"""Queries over vectors and indexes: similarity, BM25, fusion, greedy dedup, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.functions import vectors as V
from textloom.functions.stem import Analyzer, analyzed_terms
from textloom.operators import dedup, retrieve, training, vectorindex
from textloom.operators.lineage import stored, version
from textloom.plans.common import TURNS, ASKED, BM25, POSTINGS, SCORED, DENSE, VECTORS, Query, asked, benchmark, s_tokens, scratch, table

NEAR, K = 0.30, 20


def units(spark, d):
    return table(spark, d, "embeddings").select("vec_id", "label", V.l2_normalize("embedding").alias("v"))


def corpus(spark, d):
    return units(spark, d).select(F.col("vec_id").alias("doc_key"), "v")


def every_twentieth(spark, d):
    """The stated query set of searches: ids divisible by 20, against all rows."""
    return units(spark, d).filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "v")


BUILT: dict[tuple[str, str], str] = {}  # where this application keeps the index of a table's files


def index(spark, d):
    """The BM25 index of the documents: built once for the files as they are, then loaded."""
    key = spark.sparkContext.applicationId, version(spark, f"{d}/documents.parquet")
    if key not in BUILT:
        BUILT[key] = retrieve.build_index(table(spark, d, "documents").select("doc_id", "text")).path
    return retrieve.load_index(spark, BUILT[key])


def document_vectors(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("doc_key"), V.hashed_embedding("text").alias("v"))


def found_bm25(spark, d, k=60):
    return retrieve.bm25(index(spark, d), benchmark(spark, d), k)


def answers(spark, d, k):
    """The same, searched once and stored for a query that reads them several times."""
    return stored(found_bm25(spark, d, k), "answers")


def found_documents(spark, d, found):
    """The documents that a stored search found."""
    return retrieve.only(table(spark, d, "documents"), found.select(F.col("doc_key").alias("doc_id")), "doc_id")


def l2_normalize(spark, d):
    return units(spark, d).select("vec_id", F.transform("v", lambda x: F.round(x, 6)).alias("v"), F.round(V.norm("v"), 6).alias("norm"))


def cosine_pairs(spark, d):
    e = table(spark, d, "embeddings")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(nxt, "vec_id").select("vec_id", F.round(V.cosine("embedding", "other"), 6).alias("cosine"))


def hashed_embedding(spark, d):
    return benchmark(spark, d).select("query_id", F.transform(V.hashed_embedding("text"), lambda x: F.round(x, 6)).alias("v"))


def knn_self_join(spark, d):
    u = units(spark, d)
    found = retrieve.nearest(u.select(F.col("vec_id").alias("query_id"), "v"), corpus(spark, d), 5, skip_self=True)
    return found.select("query_id", "doc_key", F.round("score", 6).alias("score"), "rank")


def dense_topk(spark, d):
    return retrieve.nearest(every_twentieth(spark, d), corpus(spark, d), 10).select("query_id", "doc_key", F.round("score", 6).alias("score"), "rank")


def dense_topk_l2(spark, d):
    found = retrieve.nearest(every_twentieth(spark, d), corpus(spark, d), 10, metric="l2")
    return found.select("query_id", "doc_key", F.round("score", 6).alias("score"), "rank")


def vector_index(spark, d):
    return vectorindex.build_vector_index(corpus(spark, d), scratch(spark, "vector-index"))


def vector_search(spark, d):
    """The same question asked of a stored index: lists as measured at its building, best codes scored in full."""
    found = vectorindex.search(vector_index(spark, d), every_twentieth(spark, d), 10)
    return found.select("query_id", "doc_key", F.round("score", 6).alias("score"), "rank")


def vector_search_all_lists(spark, d):
    """With all lists probed and 100 times k rows scored in full the index gives the rows of a scan."""
    index = vector_index(spark, d)
    found = vectorindex.search(index, every_twentieth(spark, d), 10, probes=len(index.centroids), rerank=1000)
    return found.select("query_id", "doc_key", F.round("score", 6).alias("score"), "rank")


def knn_index_join(spark, d):
    """Every row's nearest others by the index."""
    rows = units(spark, d).select(F.col("vec_id").alias("query_id"), "v")
    found = vectorindex.search(vector_index(spark, d), rows, 5, skip_self=True)
    return found.select("query_id", "doc_key", F.round("score", 6).alias("score"), "rank")


def vector_index_report(spark, d):
    return vectorindex.report(vector_index(spark, d), every_twentieth(spark, d), 10)


def bm25_stats(spark, d):
    i = index(spark, d)
    return i.terms.select("term", "df", F.round("idf", 6).alias("idf"))


def bm25_topk(spark, d):
    return found_bm25(spark, d, 10).select("query_id", "doc_key", F.round("score", 6).alias("score"), "rank")


def bm25_fill(spark, d):
    """Each word of the questions as a query of its own: where fewer than ten documents hold it, others fill the list."""
    q = benchmark(spark, d).select(F.explode(T.tokenize("text")).alias("text")).distinct().select(F.col("text").alias("query_id"), "text")
    return retrieve.bm25(index(spark, d), q, 10, fill=True).select("query_id", "doc_key", F.round("score", 6).alias("score"), "rank")


def bm25_stemmed(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    i = retrieve.build_index(docs, tokenizer="stemmed", analyzer=Analyzer)
    terms = analyzed_terms(benchmark(spark, d), "query_id", "text").select("query_id", "term")
    return retrieve.bm25(i, benchmark(spark, d), 10, terms=terms)


def _hybrid(method):
    def run(spark, d):
        found = retrieve.retrieve(benchmark(spark, d), index(spark, d), document_vectors(spark, d), V.hashed_embedding, "hybrid", method)
        return found.select("query_id", "doc_key", F.round("fused", 6 if method == "linear" else 9).alias("fused"), "rank", "dense_rank", "bm25_rank")

    return run


def retrieve_dense(spark, d):
    found = retrieve.retrieve(benchmark(spark, d), None, document_vectors(spark, d), V.hashed_embedding, "dense", k=10)
    return found.select("query_id", "doc_key", F.round("fused", 6).alias("fused"), "rank", "dense_rank", "bm25_rank")


def rerank_hits(spark, d):
    best = answers(spark, d, 10)
    found = best.join(benchmark(spark, d).withColumnRenamed("text", "query_text"), "query_id")
    rows = retrieve.hits(found, found_documents(spark, d, best), "doc_id", "text")
    out = retrieve.rerank(rows)
    return out.select("query_id", "doc_key", F.round("rerank_score", 6).alias("rerank_score"), "rerank_rank")


def ndcg_mrr(spark, d):
    found = retrieve.nearest(every_twentieth(spark, d), corpus(spark, d), 21, skip_self=True)
    labels = units(spark, d).select("vec_id", "label")
    rows = found.join(labels.select(F.col("vec_id").alias("query_id"), F.col("label").alias("ql")), "query_id").join(labels.select(F.col("vec_id").alias("doc_key"), F.col("label").alias("dl")), "doc_key")
    rows = rows.select("query_id", F.col("rank").alias("pos"), "score", (F.col("ql") == F.col("dl")).cast("int").alias("rel"))
    return training.ranking_metrics(rows, 10).select("num_queries", F.round("ndcg", 6).alias("ndcg"), F.round("mrr", 6).alias("mrr"))


def near_dedup(spark, d):
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return dedup.near_dedup(rows, NEAR, K)


def cosine_dedup_candidates(spark, d):
    found = retrieve.nearest(every_twentieth(spark, d), corpus(spark, d), 15, skip_self=True)
    rows = found.join(corpus(spark, d), "doc_key").select(F.col("query_id").alias("grp"), F.col("rank").alias("ord"), "v", "doc_key")
    kept = dedup.within_groups(rows, NEAR)
    return rows.select("grp", F.col("ord").cast("long").alias("ord"), "doc_key").join(kept, ["grp", "ord"]).select(F.col("grp").alias("query_id"), "doc_key", "kept")


def query_semantic_dedup(spark, d):
    """Every user turn's text, by its order; short ones stay."""
    q = asked(spark, d).select(F.col("ord").alias("id"), "text")
    return dedup.query_dedup(q, 30, 0.95, 50).select("id", "removed")


def merge_queries_exact(spark, d):
    q = asked(spark, d).select("query_id", "ord")
    return dedup.merge_exact(q.filter(F.col("ord") < 50 * TURNS), q.filter(F.col("ord") >= 40 * TURNS))


def orphan_doc_ids(spark, d):
    keys = index(spark, d).lengths.select(F.col("doc_key").alias("doc_id"))
    return retrieve.orphans(keys, table(spark, d, "labels"), "doc_id")


def alignment_check(spark, d):
    return retrieve.alignment(table(spark, d, "documents"), table(spark, d, "embeddings"), "doc_id", "vec_id")


PAIRS = "list_dot_product(a.v, b.v)"
KNN = f"""knn AS MATERIALIZED (SELECT query_id, doc_key, score, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_key) AS INTEGER) AS rank FROM (
  SELECT a.vec_id AS query_id, b.vec_id AS doc_key, {PAIRS} AS score FROM units a, units b WHERE a.vec_id <> b.vec_id)) WHERE rank <= 20)"""
TOP = lambda score, where="true", more="": f"""WITH {VECTORS} SELECT query_id, doc_key, round(score, 6) AS score, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_key) AS INTEGER) AS rank FROM (
  SELECT a.vec_id AS query_id, b.vec_id AS doc_key, {score} AS score FROM units a, units b WHERE {where}))"""  # noqa: E731
FUSED = lambda score, places: f"""WITH {BM25}, {DENSE}, both_ AS (SELECT coalesce(d.query_id, s.query_id) AS query_id, coalesce(d.doc_key, s.doc_key) AS doc_key, d.rank AS dense_rank, s.rank AS bm25_rank, d.score AS ds, s.score AS ss FROM dense d FULL JOIN bm25 s ON s.query_id = d.query_id AND s.doc_key = d.doc_key),
  f AS (SELECT *, {score} AS fused FROM both_)
  SELECT query_id, doc_key, round(fused, {places}) AS fused, rank, dense_rank, bm25_rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(fused, 12) DESC, coalesce(dense_rank, 2147483647), coalesce(bm25_rank, 2147483647), doc_key) AS INTEGER) AS rank FROM f) WHERE rank <= 30"""  # noqa: E731
ONE, HALF = "CAST(1 AS DOUBLE)", "CAST(0.5 AS DOUBLE)"

QUERIES = {
    "l2_normalize": Query(l2_normalize, f"WITH {VECTORS} SELECT vec_id, list_transform(v, lambda x: round(x, 6)) AS v, round(sqrt(list_dot_product(v, v)), 6) AS norm FROM units"),
    "cosine_pairs": Query(cosine_pairs, f"WITH {VECTORS} SELECT a.vec_id, round({PAIRS}, 6) AS cosine FROM units a JOIN units b ON b.vec_id = a.vec_id + 1"),
    "hashed_embedding": Query(hashed_embedding, f"WITH {DENSE} SELECT query_id, list_transform(c, lambda x: round(x / n, 6)) AS v FROM queryvec"),
    "knn_self_join": Query(knn_self_join, TOP(PAIRS, "a.vec_id <> b.vec_id") + " WHERE rank <= 5"),
    "dense_topk": Query(dense_topk, TOP(PAIRS, "a.vec_id % 20 = 0") + " WHERE rank <= 10"),
    "dense_topk_l2": Query(dense_topk_l2, TOP("-pow(list_distance(a.v, b.v), 2)", "a.vec_id % 20 = 0") + " WHERE rank <= 10"),
    "vector_search": Query(vector_search, None),
    "vector_search_all_lists": Query(vector_search_all_lists, TOP(PAIRS, "a.vec_id % 20 = 0") + " WHERE rank <= 10"),
    "knn_index_join": Query(knn_index_join, None),
    "vector_index_report": Query(vector_index_report, None),
    "bm25_stats": Query(bm25_stats, f"WITH {BM25} SELECT term, df, round(idf, 6) AS idf FROM idf"),
    "bm25_topk": Query(bm25_topk, f"WITH {BM25} SELECT query_id, doc_key, round(score, 6) AS score, rank FROM bm25 WHERE rank <= 10"),
    "bm25_fill": Query(bm25_fill, f"""WITH {POSTINGS}, wanted AS (SELECT DISTINCT term AS query_id, term, 1 AS times FROM (SELECT unnest({s_tokens('text')}) AS term FROM benchmark)), {SCORED},
        few AS (SELECT query_id FROM (SELECT DISTINCT query_id FROM wanted) LEFT JOIN scored USING (query_id) GROUP BY query_id HAVING count(doc_key) < 10),
        filled AS (SELECT query_id, doc_key, score FROM scored UNION ALL SELECT query_id, doc_id, CAST(0 AS DOUBLE) FROM few, (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 20) WHERE (query_id, doc_id) NOT IN (SELECT (query_id, doc_key) FROM scored))
        SELECT query_id, doc_key, round(score, 6) AS score, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_key) AS INTEGER) AS rank FROM filled) WHERE rank <= 10"""),
    "bm25_stemmed": Query(bm25_stemmed, None),
    "rrf_fusion": Query(_hybrid("rrf"), FUSED(f"coalesce({ONE} / (60 + dense_rank), 0) + coalesce({ONE} / (60 + bm25_rank), 0)", 9)),
    "linear_fusion": Query(_hybrid("linear"), FUSED(f"{HALF} * coalesce(ds, 0) + {HALF} * coalesce(ss, 0)", 6)),
    "retrieve_dense": Query(retrieve_dense, f"WITH {DENSE} SELECT query_id, doc_key, round(score, 6) AS fused, rank, rank AS dense_rank, CAST(NULL AS INTEGER) AS bm25_rank FROM dense WHERE rank <= 10"),
    "rerank_hits": Query(rerank_hits, f"""WITH {BM25}, h AS (SELECT b.query_id, b.doc_key, b.rank, list_distinct({s_tokens('q.text')}) AS a, list_distinct({s_tokens('t.text')}) AS d FROM bm25 b JOIN benchmark q ON q.item_id = b.query_id JOIN documents t ON t.doc_id = b.doc_key WHERE b.rank <= 10),
        s AS (SELECT *, CAST(len(list_intersect(a, d)) AS DOUBLE) / len(a) AS x FROM h) SELECT query_id, doc_key, round(x, 6) AS rerank_score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(x, 6) DESC, rank) AS INTEGER) AS rerank_rank FROM s"""),
    "ndcg_mrr": Query(ndcg_mrr, f"""WITH {VECTORS}, t AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(s, 6) DESC, k) AS r FROM (SELECT a.vec_id AS q, b.vec_id AS k, {PAIRS} AS s, CAST(a.label = b.label AS INTEGER) AS rel FROM units a, units b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)),
        i AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY rel DESC, r) AS ideal FROM t WHERE r <= 21),
        m AS (SELECT q, sum(CASE WHEN r <= 10 THEN rel / log2(r + 1) ELSE 0 END) AS dcg, sum(CASE WHEN ideal <= 10 THEN rel / log2(ideal + 1) ELSE 0 END) AS best, min(CASE WHEN rel > 0 AND r <= 10 THEN r END) AS f FROM i GROUP BY q)
        SELECT count(*) AS num_queries, round(avg(CASE WHEN best > 0 THEN dcg / best ELSE 0 END), 6) AS ndcg, round(avg(coalesce({ONE} / f, 0)), 6) AS mrr FROM m"""),
    "near_dedup": Query(near_dedup, f"""WITH RECURSIVE {VECTORS}, {KNN}, e AS MATERIALIZED (SELECT query_id AS src, list(doc_key) AS dsts FROM knn WHERE rank <= {K - 1} AND score >= CAST({NEAR} AS DOUBLE) AND doc_key > query_id GROUP BY query_id),
        o AS MATERIALIZED (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS n FROM embeddings),
        scan AS (SELECT CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS gone UNION ALL
          SELECT o.n, CASE WHEN list_contains(s.gone, o.vec_id) OR e.dsts IS NULL THEN s.gone ELSE list_distinct(list_concat(s.gone, e.dsts)) END FROM scan s JOIN o ON o.n = s.n + 1 LEFT JOIN e ON e.src = o.vec_id)
        SELECT vec_id AS id, list_contains((SELECT gone FROM scan ORDER BY n DESC LIMIT 1), vec_id) AS removed FROM embeddings"""),
    "cosine_dedup_candidates": Query(cosine_dedup_candidates, f"""WITH RECURSIVE {VECTORS}, {KNN}, c AS (SELECT query_id, doc_key, CAST(rank AS BIGINT) AS ord, v FROM knn JOIN units ON vec_id = doc_key WHERE rank <= 15 AND query_id % 20 = 0),
        x AS (SELECT b.query_id, b.ord, list(a.ord) FILTER ({PAIRS} > CAST({NEAR} AS DOUBLE)) AS near FROM c b LEFT JOIN c a ON a.query_id = b.query_id AND a.ord < b.ord GROUP BY ALL),
        scan AS (SELECT DISTINCT query_id, CAST(0 AS BIGINT) AS ord, CAST([] AS BIGINT[]) AS kept FROM c UNION ALL
          SELECT x.query_id, x.ord, CASE WHEN list_has_any(s.kept, coalesce(x.near, [])) THEN s.kept ELSE list_append(s.kept, x.ord) END FROM scan s JOIN x ON x.query_id = s.query_id AND x.ord = s.ord + 1)
        SELECT c.query_id, c.doc_key, list_contains(f.kept, c.ord) AS kept FROM c JOIN (SELECT query_id, arg_max(kept, ord) AS kept FROM scan GROUP BY query_id) f USING (query_id)"""),
    "query_semantic_dedup": Query(query_semantic_dedup, None),
    "merge_queries_exact": Query(merge_queries_exact, f"WITH {ASKED}, a AS (SELECT query_id, ord FROM asked WHERE ord < {50 * TURNS}) SELECT * FROM a UNION ALL SELECT query_id, ord FROM asked WHERE ord >= {40 * TURNS} AND query_id NOT IN (SELECT query_id FROM a)"),
    "orphan_doc_ids": Query(orphan_doc_ids, "SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"),
    "alignment_check": Query(alignment_check, "SELECT (SELECT count(*) FROM documents) AS n_chunks, (SELECT count(*) FROM embeddings) AS n_vectors, (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)) AS chunks_without, (SELECT count(*) FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents)) AS vectors_without"),
}
