import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom import engine
from textloom.functions import calls
from textloom.functions import vectors as V
from textloom.functions.stem import Analyzer, analyzed_terms
from textloom.operators import answer, crawl, dedup, mining, retrieve, rows, training
from textloom.sources import jsonl, stores
from textloom.streaming import incremental


def test_keep_first(spark):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a"), (3, "c"), (4, "b")], "ord int, h string")
    assert sorted(r.ord for r in dedup.keep_first(df, ["h"], ["ord"]).collect()) == [0, 1, 3]
    odd = spark.createDataFrame([(3, None), (1, None), (None, "a"), (2, "a"), (2, "b"), (2, "b")], "ord int, h string")
    assert sorted(map(tuple, dedup.keep_first(odd, ["h"], ["ord"]).collect()), key=repr) == [(1, None), (2, "b"), (None, "a")]
    with pytest.raises(Exception, match="no h"):
        dedup.require_key(spark.createDataFrame([(1, None)], "ord int, h string"), "h").collect()


def scan(n, edges):
    gone = set()
    for i in range(n):
        if i not in gone:
            gone |= {b for a, b in edges if a == i}
    return gone


def test_greedy_is_the_sequential_scan(spark):
    rng = random.Random(7)
    for n in (0, 1, 30):
        edges = sorted({(a, b) for a, b in ((rng.randrange(n or 1), rng.randrange(n or 1)) for _ in range(n * 2)) if a < b} | {(i, i + 1) for i in range(n // 2)})
        nodes, links = spark.createDataFrame([(i,) for i in range(n)], "id long"), spark.createDataFrame(edges, "src long, dst long")
        got = {r.id for r in dedup.greedy(nodes, links).filter("removed").collect()}
        assert got == scan(n, edges)


def test_near_dedup(spark):
    rows_ = [(0, [1.0, 0.0, 0.0]), (1, [1.0, 0.01, 0.0]), (2, [0.0, 1.0, 0.0]), (3, [1.0, 0.02, 0.0]), (4, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows_, "id long, embedding array<double>")
    assert {r.id for r in dedup.near_dedup(df, 0.95, 5).filter("removed").collect()} == {1, 3, 4}
    again = df.join(dedup.near_dedup(df, 0.95, 5).filter("not removed"), "id", "left_semi")
    assert dedup.near_dedup(again, 0.95, 5).filter("removed").count() == 0
    assert dedup.near_dedup(df.limit(0), 0.95, 5).count() == 0
    with pytest.raises(ValueError):
        dedup.near_dedup(df, 0.95, 1)


def test_within_groups_is_strict(spark):
    df = spark.createDataFrame([("q", 0, [1.0, 0.0]), ("q", 1, [1.0, 0.0]), ("q", 2, [0.0, 1.0]), ("r", 5, [1.0, 0.0])], "grp string, ord long, v array<double>")
    got = {(r.grp, r.ord): r.kept for r in dedup.within_groups(df, 0.9).collect()}
    assert got == {("q", 0): True, ("q", 1): False, ("q", 2): True, ("r", 5): True}
    assert all(r.kept for r in dedup.within_groups(df, 1.0).collect())


def test_nearest_against_numpy(spark):
    rng = np.random.default_rng(2)
    d, q = rng.normal(size=(2500, 8)), rng.normal(size=(30, 8))
    docs = spark.createDataFrame([(f"k{i:04}", x.tolist()) for i, x in enumerate(d)], "doc_key string, v array<double>")
    asked = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q)], "query_id long, v array<double>")
    for metric, score in (("dot", q @ d.T), ("l2", -((q[:, None] - d) ** 2).sum(2))):
        got = {}
        for r in retrieve.nearest(asked, docs, 7, metric=metric).collect():
            got.setdefault(r.query_id, {})[r["rank"]] = r.doc_key
        for i in range(len(q)):
            order = np.lexsort((np.arange(len(d)), -np.round(score[i], 6)))[:7]
            assert [got[i][k] for k in range(1, 8)] == [f"k{j:04}" for j in order]


def test_fusion(spark):
    kind = "query_id int, doc_key string, score double, rank int"
    dense, sparse = spark.createDataFrame([(1, "c1", 0.9, 1), (1, "c2", 0.1, 2)], kind), spark.createDataFrame([(1, "c1", 10.0, 1), (1, "c3", 3.0, 2)], kind)
    got = retrieve.fuse(dense, sparse, 3).orderBy("rank").collect()
    assert [r.doc_key for r in got] == ["c1", "c2", "c3"] and got[0].fused == pytest.approx(2 / 61) and got[1].bm25_rank is None and got[2].dense_score is None
    linear = retrieve.fuse(dense, sparse, 3, "linear", w_dense=0.0, w_sparse=1.0).orderBy("rank").collect()
    assert [r.doc_key for r in linear] == ["c1", "c3", "c2"]
    with pytest.raises(ValueError):
        retrieve.fuse(dense, sparse, 3, "other")


def test_equal_texts_have_equal_scores(spark):
    """Else ranks by the fused score at 12 places tell copies apart by the order of summation."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words)] * 40 + [" ".join(rng.choice(words, 9)) for _ in range(300)]
    index = retrieve.build_index(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    found = retrieve.bm25(index, spark.createDataFrame([(0, " ".join(words + words[::7]))], "query_id long, text string"), 400).collect()
    assert len(found) == 340 and len({r.score for r in found if r.doc_key < 40}) == 1


def test_equal_vectors_have_equal_scores(spark):
    rng = np.random.default_rng(5)
    v, q = rng.normal(size=64).tolist(), rng.normal(size=(24, 64))
    docs = spark.createDataFrame([(i, v) for i in range(7)], "doc_key long, v array<double>").coalesce(1)
    asked = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q)], "query_id long, v array<double>").repartition(12, "query_id")
    for metric in ("dot", "l2"):
        found = retrieve.nearest(asked, docs, 7, metric=metric).collect()
        assert len(found) == 24 * 7 and len({(r.query_id, r.score) for r in found}) == 24


def okapi(docs, query):
    n, avg = len(docs), sum(map(len, docs)) / len(docs)
    df = {}
    for d in docs:
        for w in set(d):
            df[w] = df.get(w, 0) + 1
    idf = {w: math.log(n - f + 0.5) - math.log(f + 0.5) for w, f in df.items()}
    mean = sum(idf.values()) / len(idf)
    idf = {w: x if x >= 0 else 0.25 * mean for w, x in idf.items()}
    return [sum(idf.get(w, 0) * d.count(w) * 2.5 / (d.count(w) + 1.5 * (0.25 + 0.75 * len(d) / avg)) for w in query) for d in docs]


def test_bm25(spark, tmp_path):
    texts = ["red fish blue fish", "one fish", "red red dog", "", "two dogs and one cat"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    index = retrieve.build_index(docs)
    retrieve.save_index(index, f"file://{tmp_path}/i")
    index = retrieve.load_index(spark, f"file://{tmp_path}/i")
    with pytest.raises(ValueError):
        retrieve.load_index(spark, f"file://{tmp_path}/i", "stemmed")
    queries = spark.createDataFrame([(0, "red fish red"), (1, "zebra")], "query_id long, text string")
    got = {(r.query_id, r.doc_key): r.score for r in retrieve.bm25(index, queries, 4, fill=True).collect()}
    want = okapi([t.split() for t in texts], "red fish red".split())
    assert {k[1] for k in got if k[0] == 0} == {0, 1, 2, 3} and all(got[0, i] == pytest.approx(want[i]) for i in range(4))
    assert {k[1]: v for k, v in got.items() if k[0] == 1} == {0: 0, 1: 0, 2: 0, 3: 0}
    hybrid = retrieve.retrieve(queries, index, None, None, "bm25", k=2).collect()
    assert all(r.dense_rank is None and r.bm25_rank for r in hybrid)


def test_metrics(spark):
    rows_ = [("a", i, 1.0 - i / 10, r) for i, r in enumerate([0, 1, 0])] + [("b", i, 1.0 - i / 10, r) for i, r in enumerate([0, 0, 1, 0])] + [("c", 0, 1.0, 0)]
    df = spark.createDataFrame(rows_, "query_id string, pos int, score double, rel int")
    one = lambda q: training.ranking_metrics(df.filter(F.col("query_id") == q)).first()
    assert one("a").ndcg == pytest.approx(1 / math.log2(3)) and one("b").mrr == pytest.approx(1 / 3) and one("c").ndcg == one("c").mrr == 0
    assert training.ranking_metrics(df).first().num_queries == 3


def test_losses(spark):
    r = spark.range(1).select(training.pairwise_loss(F.lit(2.0), F.lit(0.0)).alias("a"), training.pairwise_loss(F.lit(-900.0), F.lit(0.0)).alias("b"), training.margin_loss(F.lit(0.3), F.lit(0.0)).alias("c")).first()
    assert r.a == pytest.approx(math.log1p(math.exp(-2))) and r.b == 900 and r.c == pytest.approx(0.7)


def test_split_is_disjoint_and_whole(spark):
    for n in (1, 7, 40):
        df = spark.createDataFrame([(f"q{i}", j) for i in range(n) for j in range(3)], "query_id string, j int")
        out = training.split(df).collect()
        parts = {s: {r.query_id for r in out if r.split == s} for s in ("train", "valid")}
        assert not parts["train"] & parts["valid"] and len(out) == 3 * n and len(parts["valid"]) == max(1, round(n * (1 - 0.85)))


def test_epoch_pairs(spark):
    packs = spark.createDataFrame([("a", "p1", ["p1", "p2"], [f"n{i}" for i in range(5)]), ("b", "p3", ["p3"], []), ("c", "p1", ["p1", "p2", "p3"], ["n1"])], "query_id string, source_id string, positives array<string>, negatives array<string>")
    pool = spark.createDataFrame([(i, f"n{i}") for i in range(10)] + [(10 + i, f"p{i}") for i in range(1, 4)], "n long, chunk_id string")
    got = training.epoch_pairs(packs, pool, 1).collect()
    again = training.epoch_pairs(packs, pool, 1).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again)) != sorted(map(tuple, training.epoch_pairs(packs, pool, 2).collect()))
    hard = [r for r in got if r.type == "hard_negative"]
    assert sum(r.query_id == "a" for r in hard) == 4 and sum(r.query_id == "c" for r in hard) == 3
    assert all(r.negative in {f"n{i}" for i in range(5, 10)} | {"p3"} for r in got if r.type == "random_negative" and r.query_id == "a")
    fallback = [r for r in got if r.type == "random_negative_fallback"]
    assert [r.query_id for r in fallback] == ["b"] and fallback[0].negative != "p3"
    with pytest.raises(Exception, match="no positives"):
        training.epoch_pairs(packs.withColumn("positives", F.array().cast("array<string>")), pool, 1).collect()


def test_eval_packs(spark):
    packs = spark.createDataFrame([("a", ["p"], [f"n{i}" for i in range(5)]), ("b", [], ["n"])], "query_id string, positives array<string>, negatives array<string>")
    r = training.eval_packs(packs, 2).collect()
    assert len(r) == 1 and r[0].labels == [1, 0, 0] and r[0].doc_ids[0] == "p" and len(r[0].doc_ids) == 3


def test_numbered_and_target(spark):
    rng = random.Random(3)
    ords = rng.sample(range(5000), 500)
    df = spark.createDataFrame([(o, o % 3 == 0) for o in ords], "ord long, in_domain boolean")
    got = {r.ord: r.n for r in mining.numbered(df, ["ord"]).collect()}
    assert got == {o: i for i, o in enumerate(sorted(ords))}
    batched = mining.batched(df, 10, ["ord"])
    kept, hits = [], 4
    for i in range(0, 500, 10):
        if hits >= 20:
            break
        part = sorted(ords)[i : i + 10]
        kept += part
        hits += sum(o % 3 == 0 for o in part)
    assert sorted(r.ord for r in mining.until_target(batched, 20, 4).collect()) == kept


def test_query_run_resumes(spark):
    chunks = spark.createDataFrame([(f"c{i}", f"The sentence number {i} is here. Another line about thing {i}.", i) for i in range(40)], "chunk_id string, chunk_text string, ord long")
    first = mining.query_run(chunks, target=10)
    rest = mining.query_run(chunks, first.select("query_id", "domain"), target=1000)
    a, b = {r.query_id for r in first.collect()}, {r.query_id for r in rest.collect()}
    assert a and b and not a & b and len(a | b) == 80


def test_packs(spark):
    chunks = spark.createDataFrame([("s", "red fish swim deep", 0), ("d", "red fish swim deep", 1), ("p", "red fish eat", 2), ("n", "unrelated words", 3), ("e", " ", 4)], "chunk_id string, chunk_text string, ord long")
    queries = spark.createDataFrame([("q", "red fish", ["s"])], "query_id string, query_text_norm string, source_chunk_ids array<string>")
    found = spark.createDataFrame([("q", k, i + 1) for i, k in enumerate(["s", "d", "p", "n", "e", "gone"])], "query_id string, doc_key string, rank int")
    r = mining.packs(queries, chunks, found, 0.95, answerable=lambda q, t: mining.coverage(q, t, 0.9)).collect()
    assert len(r) == 1 and r[0].positives == ["s", "p"] and r[0].negatives == ["n"]


def test_crawl(spark):
    link = lambda *u: "".join(f'<a href="{x}">l</a>' for x in u)
    pages = spark.createDataFrame([("http://a.com/", link("/1", "/2", "http://b.com/", "/1")), ("http://a.com/1", link("/3", "/")), ("http://a.com/2", link("/3", "/4")), ("http://a.com/3", link("/5")), ("http://a.com/4", ""), ("http://a.com/5", ""), ("http://b.com/", "")], "url string, html string")
    seeds = spark.createDataFrame([("http://a.com",)], "url string")
    got = {r.url: (r.depth, r.found_by, r.place) for r in crawl.breadth_first(pages, seeds, 2).collect()}
    assert got == {"http://a.com/": (0, "", 0), "http://a.com/1": (1, "http://a.com/", 1), "http://a.com/2": (1, "http://a.com/", 2), "http://a.com/3": (2, "http://a.com/1", 3), "http://a.com/4": (2, "http://a.com/2", 4)}
    assert crawl.breadth_first(pages, seeds, 5, per_seed=3).count() == 3 and crawl.breadth_first(pages, seeds, 5, total=4).count() == 4
    assert crawl.breadth_first(pages, seeds, 1, max_links=1).count() == 2
    assert {r.url for r in crawl.breadth_first(pages, seeds, 1, same_domain_only=False).collect()} >= {"http://b.com/"}


def test_snapshot(spark):
    pages = spark.createDataFrame([("u", "h1"), ("v", "h2"), ("w", "h3")], "url string, content_hash string")
    old = spark.createDataFrame([("u", "h1", "old/u"), ("v", "x", "old/v"), ("z", "h", "old/z")], "url string, content_hash string, rel_path string")
    got = {r.url: (r.rel_path, r.reused) for r in crawl.snapshot(pages, old).collect()}
    assert got["u"] == ("old/u", True) and not got["v"][1] and got["v"][0].startswith("raw/") and set(got) == {"u", "v", "w"}


def test_answer_chain(spark):
    q = spark.createDataFrame([(1, "about fish"), (2, "hello"), (3, " "), (4, "fish none")], "query_id int, text string")
    found = spark.createDataFrame([(1, "No match here. x", 1), (1, "All about fish. y", 2)], "query_id int, chunk_text string, rank int")
    got = {r.query_id: r for r in answer.answer_chain(q, found, ["fish"]).collect()}
    assert got[1].mode == "rag" and got[1].answer == "All about fish" and got[2].mode == "direct" and got[3].answer == "" and got[4].answer == ""


def test_direct_versus_rag(spark):
    q = spark.createDataFrame([(1, "about fish", "all about fish"), (2, "hello", "bye")], "query_id int, text string, gold string")
    found = spark.createDataFrame([(1, "No match here. x", 1), (1, "All about fish. y", 2)], "query_id int, chunk_text string, rank int")
    got = {(r.query_id, r.system): (r.answer, round(r.score, 3), r.is_correct) for r in answer.direct_versus_rag(q, found, least=0.9).collect()}
    assert got == {(1, "rag"): ("All about fish", 1.0, True), (1, "direct"): ("about fish", 0.8, False), (2, "rag"): ("", 0.0, False), (2, "direct"): ("hello", 0.0, False)}
    both = answer.direct_versus_rag(q, found)
    assert {r.system: (r.n, r.accuracy) for r in answer.judge_summary(both).collect()} == {"rag": (2, 0.5), "direct": (2, 0.5)}


def test_steady():
    now, slept, tries = [0.0], [], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    def fails(x):
        tries.append(x)
        if len(tries) < 3:
            raise OSError("busy")
        return x * 2

    how = {"sleep": sleep, "clock": lambda: now[0]}
    assert calls.steady(fails, 3, 1.0, **how)(4) == 8 and slept == [1.0, 2.0]
    with pytest.raises(OSError):
        calls.steady(lambda: (_ for _ in ()).throw(OSError()), 2, 0.5, **how)()
    with pytest.raises(ValueError):
        calls.steady(fails, 0)
    with pytest.raises(KeyError):  # an error that is not named isn't tried again
        calls.steady(lambda: {}["a"], 3, errors=(OSError,), **how)()
    slept.clear()
    slow = calls.steady(lambda x: x, per_second=2.0, **how)
    assert [slow(i) for i in range(3)] == [0, 1, 2] and slept == [0.5, 0.5]


def test_engine_and_model_hooks(spark):
    def make():
        return lambda prompts: [f"<{p}>" for p in prompts]

    docs = spark.createDataFrame([(7, "All about fish. More."), (8, "Birds fly. Far."), (9, None), (10, "Trees grow slowly")], "doc_id int, text string")
    index = retrieve.build_index(docs)
    plain = engine.Engine(index, docs, ["fish", "bird"], k=2)
    assert plain.ask("tell about fish") == {"mode": "rag", "answer": "All about fish", "context": "Document:\nAll about fish. More.", "sources": ["7"]}
    assert plain.ask("hello")["mode"] == "direct" and plain.ask("hello")["sources"] == [] and plain.ask("")["answer"] == ""
    model = {"answer": calls.by_model(make, lambda q, t: F.concat_ws("|", q, t)), "direct": calls.by_model(make, lambda q: q, batch=1)}
    hooked = engine.Engine(index, docs, ["fish", "bird"], k=2, **model)
    assert hooked.ask("fish")["answer"] == "<fish|All about fish. More.>" and hooked.ask("hello")["answer"] == "<hello>"
    bad = calls.by_model(lambda: lambda prompts: [], lambda q: q, tries=1)
    with pytest.raises(Exception, match="0 texts for 1 prompts"):
        docs.limit(1).select(bad(F.col("text"))).collect()


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n\n[1]\nnot json\n{"a": 2, "b": "x"}\n"s"\n')
    path = f"file://{tmp_path}/a.jsonl"
    good, bad = jsonl.read_jsonl(spark, path, "a int, b string", strict=False)
    assert sorted((r.a, r.b) for r in good.collect()) == [(1, None), (2, "x")] and sorted(r.line_preview for r in bad.collect()) == ['"s"', "[1]", "not json"]
    with pytest.raises(Exception, match="not a JSON object"):
        jsonl.read_jsonl(spark, path, "a int")[0].collect()
    jsonl.write_jsonl(good, f"file://{tmp_path}/out")
    jsonl.write_jsonl(good, f"file://{tmp_path}/out", append=True)
    assert jsonl.read_jsonl(spark, f"file://{tmp_path}/out", "a int")[0].count() == 4
    rows_ = spark.createDataFrame([("k", "t"), (None, "t"), ("k", " ")], "k string, t string")
    good, bad = jsonl.quarantine(rows_, "k", "t")
    assert good.count() == 1 and sorted(r.error for r in bad.collect()) == ["blank text", "missing key"]
    with pytest.raises(Exception, match="missing key|blank text"):
        jsonl.quarantine(rows_, "k", "t", strict=True)[0].collect()


def test_stores(spark, tmp_path):
    s = stores.registry(spark, {"main": {"kind": "filesystem", "root": f"file://{tmp_path}"}})["main"]
    s.save(spark.range(3), "t/x")
    assert s.exists("t/x") and not s.exists("nope") and s.table("t/x").count() == 3 and any(p.startswith("t/x/part") for p in s.list()) and s.list("nope") == []
    assert s.binary("t/x").count() >= 1
    for bad in ({"a": {"kind": "tape", "root": "x"}}, {"a": {"kind": "object"}}):
        with pytest.raises(ValueError):
            stores.registry(spark, bad)
    with pytest.raises(ValueError):
        s.uri("../x")


def test_settings(tmp_path):
    (tmp_path / "c.yaml").write_text("a: {b: 2}\nc: 3\n")
    got = stores.load_settings(str(tmp_path / "c.yaml"), {"a": {"b": 1, "d": 4}}, {"a.b": lambda x: x > 1})
    assert got["a"] == {"b": 2, "d": 4} and len(got["_meta"]["fingerprint"]) == 64 and stores.get(got, "a.x", None) is None
    with pytest.raises(KeyError):
        stores.get(got, "a.x")
    with pytest.raises(ValueError):
        stores.settings({"a": 1}, {"a": -1}, {"a": lambda x: x > 0})


def test_streams(spark, tmp_path):
    source = spark.createDataFrame([(i % 5, f"2024-01-01T0{i % 3}:10:00", "t", 1.0) for i in range(30)], "k int, ts string, event_type string, value double").withColumn("ts", F.to_timestamp("ts"))
    source.repartition(3).write.parquet(f"{tmp_path}/in")
    run = lambda: incremental.run_to_end(incremental.new_once(incremental.table_stream(spark, f"{tmp_path}/in", source.schema), "k"), f"{tmp_path}/out", f"{tmp_path}/state")
    run()
    source.withColumn("k", F.col("k") + 3).limit(5).write.mode("append").parquet(f"{tmp_path}/in")
    run()
    got = sorted(r.k for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert len(got) == len(set(got)) and set(range(5)) <= set(got)
    windows = incremental.windowed_counts(incremental.table_stream(spark, f"{tmp_path}/in", source.schema))
    incremental.run_to_end(windows, f"{tmp_path}/w", f"{tmp_path}/ws")
    assert windows.isStreaming and set(spark.read.parquet(f"{tmp_path}/w").columns) == {"window", "event_type", "n", "total"}


def test_append_and_merge(spark):
    rows_ = spark.createDataFrame([("a", 3), ("b", 1), ("b", 2)], "k string, ord int")
    assert sorted(map(tuple, incremental.append_new(rows_, spark.createDataFrame([("a",)], "k string"), "k").collect())) == [("b", 1)]
    merged = incremental.merge_manifest(spark.createDataFrame([("u", 2, "new")], "url string, ord int, h string"), spark.createDataFrame([("u", 1, "old"), ("v", 1, "x")], "url string, ord int, h string"))
    assert {r.url: r.h for r in merged.collect()} == {"u": "new", "v": "x"}


def test_alignment(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "c int"), spark.createDataFrame([(2,), (3,), (4,)], "v int")
    assert tuple(retrieve.alignment(a, b, "c", "v").first()) == (2, 3, 1, 2)
    assert [r.v for r in retrieve.orphans(b.withColumnRenamed("v", "v"), a.withColumnRenamed("c", "v"), "v").orderBy("v").collect()] == [3, 4]


def test_rows(spark):
    made = rows.coerce_chunks(spark.createDataFrame([("c", "x", "7"), (None, None, "y")], "chunk_id string, chunk_text string, chunk_index string")).collect()
    assert made[0].chunk_index == 7 and made[1].chunk_index == 0 and made[1].chunk_text == "" and made[0].title is None
    stages = {}
    with rows.timed(stages, "s"):
        pass
    assert stages["s"] >= 0
    df = spark.range(5)
    assert rows.prune(df, df.filter("id > 2"), "id").count() == 3 and rows.prune(df, df, "id", enabled=False).count() == 5


def test_hashed_embedding_is_deterministic(spark):
    r = spark.createDataFrame([("a b a",), ("",), (None,)], "t string").select(V.hashed_embedding("t", 16).alias("v")).collect()
    assert sum(x * x for x in r[0].v) == pytest.approx(1) and sum(r[1].v) == sum(r[2].v) == 0


def test_every_draw_finds_a_chunk(spark):
    n = 200
    pool = spark.createDataFrame([(i, f"c{i}") for i in range(n)], "n long, chunk_id string")
    allowed = {"few": {7, 150}, "one": {0}, "none": set(), "all": set(range(n))}
    banned = spark.createDataFrame([(q, f"c{i}") for q, ok in allowed.items() for i in range(n) if i not in ok] + [("few", "elsewhere"), ("few", "c3")], "query_id string, chunk_id string")
    needs = spark.createDataFrame([(f"{q}-{k}", q) for q in allowed for k in range(60)], "draw string, query_id string")
    got = {}
    for r in training.random_chunks(needs, pool, banned, 5).collect():
        got.setdefault(r.query_id, []).append(int(r.chunk_id[1:]))
    assert {q: len(v) for q, v in got.items()} == {"few": 60, "one": 60, "all": 60}
    assert set(got["few"]) == {7, 150} and set(got["one"]) == {0} and len(set(got["all"])) > 40


def test_a_cell_gives_k_rows_a_query_and_the_grid_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(retrieve, "BLOCK", 4)
    monkeypatch.setattr(retrieve, "HELD", 2)
    rng = random.Random(8)
    vectors = [[float(rng.randrange(3)), float(rng.randrange(3)), 1.0] for _ in range(60)]  # many ties
    for name in (int, lambda i: f"k{i:03}"):
        rows = [(name(i), v) for i, v in enumerate(vectors)]
        kind = "bigint" if name is int else "string"
        docs, q = spark.createDataFrame(rows, f"doc_key {kind}, v array<double>"), spark.createDataFrame(rows[:9], f"query_id {kind}, v array<double>")
        want = {(a, b, r + 1) for a, x in rows[:9] for r, (_, b) in enumerate(sorted((-sum(s * t for s, t in zip(x, y, strict=True)), b) for b, y in rows if b != a)[:5])}
        for slots in (None, 1, 3):
            assert {(r.query_id, r.doc_key, r["rank"]) for r in retrieve.nearest(q, docs, 5, skip_self=True, slots=slots).collect()} == want
    seen = []
    monkeypatch.setattr(retrieve, "top", lambda rows, k: seen.append(rows) or rows.withColumn("rank", F.lit(1)))
    monkeypatch.setattr(retrieve, "HELD", 32)
    retrieve.nearest(q, docs, 5, slots=1)
    assert seen[0].count() == 9 * 5  # 15 blocks were searched
    assert retrieve.grid(200, 10**7, 600) == (1, 144) and retrieve.grid(10**6, 10**6, 600) == (12, 12) and retrieve.grid(10**6, 10**6, 12)[0] * retrieve.grid(10**6, 10**6, 12)[1] <= 16 and retrieve.grid(0, 0, 1) == (1, 1)


def _greedy_by_scan(v, threshold, k):
    """Removed rows of unit vectors by number: the whole scan, in numpy."""
    s = v @ v.T
    np.fill_diagonal(s, -2)
    gone = set()
    for i in range(len(v)):
        near = np.lexsort((np.arange(len(v)), -np.round(s[i], 6)))[: k - 1]
        if i not in gone:
            gone |= {int(j) for j in near if j > i and s[i, j] >= threshold}
    return gone


@pytest.mark.parametrize("k,pairs,side", [(3, 1 << 20, 16), (3, 50, 16), (8, 50, 1), (50, 1 << 20, 16)])
def test_near_dedup_of_copies_and_near_copies(spark, monkeypatch, k, pairs, side):
    """More copies of a vector than k, near copies, far ones, and a zero vector, in a grid of several cells."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 6))
    v = np.concatenate([base, base[:10] + 0.05 * rng.normal(size=(10, 6)), np.repeat(base[:4], 9, axis=0), base[:20] + 0.2 * rng.normal(size=(20, 6)), np.zeros((3, 6))])
    v = v[rng.permutation(len(v))]
    v /= np.maximum(np.linalg.norm(v, axis=1), 1e-12)[:, None]
    monkeypatch.setattr(retrieve, "PAIRS", pairs)
    monkeypatch.setattr(retrieve, "MOST_SIDE", side)
    monkeypatch.setattr(retrieve, "BLOCK", 4)
    got = dedup.near_dedup(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, embedding array<double>"), 0.95, k).collect()
    assert {r.id for r in got if r.removed} == _greedy_by_scan(v, 0.95, k) and len(got) == len(v)


def test_only_distinct_vectors_are_compared_and_only_close_pairs_leave(spark):
    """What leaves the comparing tasks follows the close pairs, not k rows of each row and cell."""
    v = np.random.default_rng(6).normal(size=(60, 12))
    v /= np.linalg.norm(v, axis=1)[:, None]
    rows = spark.createDataFrame([(i, v[i % 60].tolist()) for i in range(600)], "id long, v array<double>")
    found = retrieve.alike(rows.filter("id < 60").withColumnRenamed("id", "doc_key"), 50, 0.95)
    assert sorted((r.query_id, r.doc_key, r["rank"]) for r in found.collect()) == [(i, i, 1) for i in range(60)]
    edges = dedup._close(rows, 0.95, 4).collect()
    assert sorted((e.src, e.dst) for e in edges) == sorted((i + 60 * a, i + 60 * b) for i in range(60) for a in range(4) for b in range(a + 1, 4))


def test_an_index_of_analyzed_terms_is_that_of_their_postings(spark, tmp_path):
    texts = ["The cats are running; a cat ran. 5 x 42", "", None, "to be or not", "Relational relations, NATIONAL nation's caf\u00e9 \u0130stanbul hopping hopped", "flies fly dies y sky skies"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = analyzed_terms(docs, "doc_id", "text").groupBy(F.col("doc_id").alias("doc_key"), "term").agg(F.count("*").alias("tf"))
    want = retrieve.build_index(docs, postings=counts, tokenizer="stemmed", path=f"file://{tmp_path}/a")
    got = retrieve.build_index(docs, tokenizer="stemmed", path=f"file://{tmp_path}/b", analyzer=lambda: Analyzer(room=3))
    postings = lambda i: sorted(map(tuple, i.blocks.select("term", "range", "n", "max_tf", "min_len", F.inline(F.arrays_zip("keys", "tfs", "lens"))).collect()))
    assert postings(got) == postings(want)
    for name in ("lengths", "terms"):
        assert sorted(map(tuple, getattr(got, name).collect())) == sorted(map(tuple, getattr(want, name).collect()))
    assert (got.n_docs, got.avgdl, got.mean_raw, got.tokenizer) == (want.n_docs, want.avgdl, want.mean_raw, "stemmed")
