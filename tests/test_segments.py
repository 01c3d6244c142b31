import math
import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import retrieve
from textloom.plans import search
from textloom.plans.catalog import CATALOG

KIND = "doc_id long, text string"


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    return [(i, None if i % 41 == 7 else " ".join(rng.choices(words, weights, k=rng.choice([0, 3, 12, 40])))) for i in range(n)]


def brute(docs, queries, k):
    tokens = {i: (t or "").split() for i, t in docs}
    n, avg = len(docs), sum(map(len, tokens.values())) / len(docs)
    df = {}
    for ts in tokens.values():
        for t in set(ts):
            df[t] = df.get(t, 0) + 1
    raw = {t: math.log(n - c + 0.5) - math.log(c + 0.5) for t, c in df.items()}
    idf = {t: r if r >= 0 else 0.25 * sum(raw.values()) / len(raw) for t, r in raw.items()}
    out = set()
    for q, text in queries:
        scores = {}
        for i, ts in tokens.items():
            hit = [t for t in text.split() if t in ts]
            if hit:
                scores[i] = sum(idf[t] * ts.count(t) * 2.5 / (ts.count(t) + 1.5 * (0.25 + 0.75 * len(ts) / avg)) for t in hit)
        for r, (s, i) in enumerate(sorted((-round(s, 6), i) for i, s in scores.items())[:k]):
            out.add((q, i, r + 1, -s))
    return out


def found(index, queries, k, **options):
    return {(r.query_id, r.doc_key, r["rank"], round(r.score, 6)) for r in retrieve.bm25(index, queries, k, **options).collect()}


@pytest.fixture(scope="module")
def asked():
    rng = random.Random(5)
    return [(i, " ".join(f"w{rng.randrange(65)}" for _ in range(rng.choice([1, 2, 5, 9])))) for i in range(25)] + [(90, "none of these"), (91, "w3 w3 w3")]


def test_bounds_change_no_row(spark, monkeypatch, asked):
    monkeypatch.setattr(retrieve, "RANGE", 8)
    docs = corpus(1, 300)
    index = retrieve.build_index(spark.createDataFrame(docs, KIND))
    q = spark.createDataFrame(asked, "query_id long, text string")
    for k in (1, 10, 400):
        want = brute(docs, asked, k)
        assert found(index, q, k, bounded=False) == want and found(index, q, k, bounded=True) == want
    assert index.n_ranges == 38 and index.blocks.agg(F.sum("n")).first()[0] == sum(len(set((t or "").split())) for _, t in docs)
    assert index.blocks.filter((F.array_max("tfs") != F.col("max_tf")) | (F.array_min("lens") != F.col("min_len")) | (F.size("keys") != F.col("n"))).count() == 0


def test_few_ranges_are_read_where_few_can_reach(spark, monkeypatch):
    monkeypatch.setattr(retrieve, "RANGE", 8)
    docs = [(i, "common " + ("rare " * 9 if i in (5, 17, 40) else f"filler{i} " * 5)) for i in range(400)]
    index = retrieve.build_index(spark.createDataFrame(docs, KIND))
    q = spark.createDataFrame([(1, "rare common"), (2, "rare")], "query_id long, text string")
    weighted = retrieve.weighted_terms(index, q)
    early, rest = retrieve.reachable(index, weighted, 2)
    every = index.blocks.join(weighted, "term").select("query_id", "range").distinct().count()
    assert every > 50 and rest.count() <= 4
    assert {(r.query_id, r.doc_key) for r in retrieve.bm25(index, q, 3, bounded=True).collect()} == {(1, 5), (1, 17), (1, 40), (2, 5), (2, 17), (2, 40)}
    assert found(index, q, 3, bounded=True) == found(index, q, 3, bounded=False)


def test_more_documents_as_a_new_index(spark, tmp_path, monkeypatch, asked):
    monkeypatch.setattr(retrieve, "RANGE", 16)
    docs = corpus(2, 200)
    path = f"file://{tmp_path}/i"
    first = retrieve.build_index(spark.createDataFrame(docs[:120], KIND), path=path)
    retrieve.add_documents(first, spark.createDataFrame(docs[120:], KIND))
    index = retrieve.load_index(spark, path)
    q = spark.createDataFrame(asked, "query_id long, text string")
    assert index.n_docs == 200 and index.n_ranges == 8 + 5
    assert found(index, q, 7) == brute(docs, asked, 7) == found(index, q, 7, bounded=True)
    whole = retrieve.build_index(spark.createDataFrame(docs, KIND))
    told = lambda i: sorted((r.term, r.df, round(r.idf, 9)) for r in i.terms.collect())
    assert told(whole) == told(index)
    with pytest.raises(ValueError, match="tokenizer"):
        retrieve.load_index(spark, path, "stemmed")


def test_no_documents_and_no_words(spark):
    q = spark.createDataFrame([(1, "a b")], "query_id long, text string")
    for rows in ([], [(1, None), (2, " ! ")]):
        index = retrieve.build_index(spark.createDataFrame(rows, KIND))
        assert index.n_docs == len(rows) and found(index, q, 3) == set() == found(index, q, 3, bounded=True)
        assert len(found(index, q, 3, fill=True)) == len(rows)


def test_a_second_query_builds_nothing(spark, sf, monkeypatch):
    CATALOG["bm25_topk"].run(spark, sf).collect()
    monkeypatch.setattr(retrieve, "build_index", None)
    assert CATALOG["rerank_hits"].run(spark, sf).count() > 0 and CATALOG["context_block"].run(spark, sf).count() > 0
    plan = search.found_bm25(spark, sf, 10)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<term:string,keys:array" in plan and "ReadSchema: struct<doc_id" not in plan and "text:string" not in plan


def test_a_changed_table_is_indexed_anew(spark, tmp_path):
    at = f"{tmp_path}"
    spark.createDataFrame([(1, "apple")], KIND).write.parquet(f"{at}/documents.parquet")
    assert search.index(spark, at).n_docs == 1 and search.index(spark, at).path == search.index(spark, at).path
    spark.createDataFrame([(1, "apple"), (2, "pear")], KIND).write.mode("overwrite").parquet(f"{at}/documents.parquet")
    assert search.index(spark, at).n_docs == 2

def test_best_of_each_task_are_the_best_of_all(spark, monkeypatch, asked):
    """Asked in parts, with few cells held at once and few partitions: the rows of a whole scan, of numbers and names as keys."""
    monkeypatch.setattr(retrieve, "RANGE", 16)
    monkeypatch.setattr(retrieve, "WIDE", 2)
    docs = corpus(3, 300) + [(1000 + i, "w1 w2 w2 w40") for i in range(30)]
    q = spark.createDataFrame(asked, "query_id long, text string")
    index = retrieve.build_index(spark.createDataFrame(docs, KIND))
    for k, few, cells in ((1, 10**6, 10**6), (10, 20, 40), (400, 10**6, 100)):
        monkeypatch.setattr(retrieve, "FEW", few)
        monkeypatch.setattr(retrieve, "CELLS", cells)
        assert found(index, q, k) == brute(docs, asked, k) == found(index, q, k, bounded=False)
    assert found(index, q, 400, fill=True) == found(index, q, 400, fill=True, bounded=False)
    named = retrieve.build_index(spark.createDataFrame(docs, KIND).selectExpr("concat('d', doc_id + 1000) as doc_id", "text"))
    assert {(a, int(b[1:]) - 1000, c, d) for a, b, c, d in found(named, q, 10)} == found(index, q, 10)
    assert found(retrieve.build_index(spark.createDataFrame([(1, "a"), (2, "ÉAKelvin b-c_d, İx")], KIND)), spark.createDataFrame([(1, "kelvin d ix x")], "query_id long, text string"), 3, bounded=False)


def test_no_pair_of_query_and_document_is_shuffled(spark, monkeypatch, asked):
    monkeypatch.setattr(retrieve, "WIDE", 1)
    index = retrieve.build_index(spark.createDataFrame(corpus(4, 100), KIND))
    out = retrieve.bm25(index, spark.createDataFrame(asked, "query_id long, text string"), 5)
    assert "HashAggregate(keys=[query_id" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == len(brute(corpus(4, 100), asked, 5))
