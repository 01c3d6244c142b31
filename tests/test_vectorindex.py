import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.functions import vectors as V
from textloom.operators import dedup, retrieve, vectorindex
from textloom.plans.catalog import CATALOG

KIND = "doc_key string, v array<double>"


def clustered(n, dims=24, centres=60, seed=1):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dims))
    x = c[rng.integers(centres, size=n)] + 0.25 * rng.normal(size=(n, dims))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def table(spark, x):
    return spark.createDataFrame([(f"k{i:05}", v.tolist()) for i, v in enumerate(x)], KIND)


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    x = clustered(3000)
    rows = table(spark, x)
    path = f"file://{tmp_path_factory.mktemp('index')}/v"
    vectorindex.build_vector_index(rows, path)
    return x, rows, vectorindex.load_vector_index(spark, path)


def asked(x, spark, step=20):
    return spark.createDataFrame([(f"k{i:05}", x[i].tolist()) for i in range(0, len(x), step)], "query_id string, v array<double>")


def test_codes_are_close():
    x = np.random.default_rng(3).normal(size=(200, 7))
    x[5] = 0
    codes, scale = vectorindex.pack_codes(x)
    assert codes.shape == (200, 4) and codes.dtype == np.uint8
    assert (np.abs(vectorindex.unpack_codes(codes, scale, 7) - x) <= np.abs(x).max(1, keepdims=True) / 15 + 1e-6).all()


def test_every_row_is_in_one_list(spark, index):
    x, rows, ix = index
    held = [int(i) for r in ix.lists.collect() for i in np.frombuffer(r.rows, "<i8")]
    assert sorted(held) == sorted(r.row for r in ix.vectors.select("row").collect()) and len(set(held)) == len(x) == ix.n_rows
    assert {r.doc_key for r in ix.vectors.collect()} == {r.doc_key for r in rows.collect()}
    of = {r.row: r for r in ix.vectors.collect()}
    for r in ix.lists.collect():
        for i in np.frombuffer(r.rows, "<i8"):
            v = np.array(of[int(i)].v)
            assert of[int(i)].list == r.list == np.argmin(((v - ix.centroids) ** 2).sum(1))


def test_recall_and_pairs(spark, index):
    x, rows, ix = index
    got = vectorindex.report(ix, asked(x, spark), 10).first()
    assert got.n_rows == 3000 and got.n_queries == 150 and got.recall >= 0.9 and got.compared < 0.1 and got.scored < 0.1
    assert ix.curve.count() == len(ix.centroids) and ix.probes < len(ix.centroids) / 4


def test_all_lists_give_the_exact_rows(spark, index):
    x, rows, ix = index
    q = asked(x, spark, 100)
    got = vectorindex.search(ix, q, 10, probes=len(ix.centroids), rerank=200)
    want = retrieve.nearest(q, rows, 10)
    key = lambda r: (r.query_id, r["rank"])
    for a, b in zip(sorted(got.collect(), key=key), sorted(want.collect(), key=key), strict=True):
        assert (a.query_id, a.doc_key, a["rank"]) == (b.query_id, b.doc_key, b["rank"]) and a.score == pytest.approx(b.score)
    own = vectorindex.search(ix, q, 3, skip_self=True).filter("query_id = doc_key")
    assert own.count() == 0
    with pytest.raises(ValueError):
        vectorindex.search(ix, q, 10, rerank=5)


def test_small_tasks_and_blocks_change_nothing(spark, index, monkeypatch, tmp_path):
    x, rows, ix = index
    q = asked(x, spark, 200)
    want = sorted(map(tuple, vectorindex.search(ix, q, 5).collect()))
    monkeypatch.setattr(vectorindex, "HELD", 50)
    assert sorted(map(tuple, vectorindex.search(ix, q, 5).collect())) == want


def test_add_and_load(spark, tmp_path):
    x = clustered(900, seed=2)
    path = f"file://{tmp_path}/v"
    ix = vectorindex.build_vector_index(table(spark, x[:600]), path)
    more = spark.createDataFrame([(f"k{i:05}", x[i].tolist()) for i in range(600, 900)] + [("none", None), ("short", [1.0])], KIND)
    vectorindex.add(ix, more)
    again = vectorindex.load_vector_index(spark, path)
    assert (again.n_rows, again.n_skipped) == (900, 2) and again.vectors.count() == 900
    assert sum(len(r.rows) for r in again.lists.collect()) == 8 * 900
    q = asked(x, spark, 50)
    first = {r.query_id: r.doc_key for r in vectorindex.search(again, q, 1).collect()}
    assert first == {r.query_id: r.query_id for r in q.collect()}


def test_nulls_lengths_repeats_and_no_rows(spark, tmp_path):
    odd = [("a", None), ("b", [1.0, None]), ("c", [float("nan"), 1.0]), ("d", [float("inf"), 1.0]), ("e", []), ("f", [1.0, 0.0, 0.0])]
    rows = spark.createDataFrame(odd + [("x", [1.0, 0.0])] * 40 + [("y", [0.0, 1.0])] * 3 + [("z", [0.0, 0.0])], KIND)
    ix = vectorindex.build_vector_index(rows, f"file://{tmp_path}/v", n_lists=3, k=2)
    assert (ix.n_rows, ix.n_skipped) == (44, 6)
    q = spark.createDataFrame([("1", [1.0, 0.2]), ("2", None), ("3", [1.0]), ("4", [0.1, 1.0])], "query_id string, v array<double>")
    got = vectorindex.search(ix, q, 5, probes=3).collect()
    assert [r.doc_key for r in sorted(got, key=lambda r: (r.query_id, r["rank"]))] == ["x"] * 5 + ["y"] * 3 + ["x"] * 2
    empty = vectorindex.build_vector_index(rows.limit(0), f"file://{tmp_path}/e")
    assert vectorindex.search(empty, q, 5).count() == 0 and empty.n_rows == 0
    with pytest.raises(ValueError):
        vectorindex.add(empty, rows)


def test_nearest_with_nulls_and_lengths(spark):
    docs = spark.createDataFrame([("a", [1.0, 0.0]), ("b", None), ("c", [1.0, 2.0, 3.0]), ("d", [float("nan"), 1.0]), ("e", [0.5, 0.5]), ("f", []), ("g", [None, 1.0])], KIND)
    q = docs.withColumnRenamed("doc_key", "query_id")
    got = sorted((r.query_id, r.doc_key, r["rank"]) for r in retrieve.nearest(q, docs, 3).collect())
    assert got == [("a", "a", 1), ("a", "e", 2), ("c", "c", 1), ("e", "a", 1), ("e", "e", 2)]


def test_near_dedup_by_index_is_the_scan(spark, tmp_path):
    x = clustered(400, seed=4)
    rng = np.random.default_rng(5)
    copies = x[rng.integers(0, 400, 150)] + 0.01 * rng.normal(size=(150, 24))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.vstack([x, copies]))], "id long, embedding array<double>")
    exact = {r.id for r in dedup.near_dedup(rows, 0.97, 10).filter("removed").collect()}
    by_index = {r.id for r in dedup.near_dedup(rows, 0.97, 10, path=f"file://{tmp_path}/v").filter("removed").collect()}
    assert len(exact) >= 150 and len(exact & by_index) >= 0.95 * len(exact) and by_index <= exact | by_index and len(by_index - exact) <= 0.05 * len(exact)


def test_catalog_search_finds_nine_of_ten(spark, sf):
    got = CATALOG["vector_search"].run(spark, sf).select("query_id", "doc_key")
    want = CATALOG["dense_topk"].run(spark, sf).select("query_id", "doc_key")
    assert want.join(got, ["query_id", "doc_key"], "left_semi").count() >= 0.9 * want.count()


def test_usable(spark):
    df = spark.createDataFrame([(None,), ([],), ([1.0, None],), ([float("nan")],), ([float("-inf")],), ([0.0],)], "v array<double>")
    assert [r.ok for r in df.select(V.usable("v").alias("ok")).collect()] == [False] * 5 + [True]
    assert df.select(F.count_if(V.usable("v")).alias("n")).first().n == 1


def test_queries_made_by_python_are_not_broadcast(spark, index):
    x, rows, i = index
    _, pairs = vectorindex._pairs(i, asked(x, spark), None)
    found = retrieve.nearest(asked(x, spark), rows, 3)
    for plan in (p._jdf.queryExecution().executedPlan().toString() for p in (pairs, found)):
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_few_rows_of_a_query_leave_a_task(spark, index, monkeypatch):
    x, rows, ix = index
    q = asked(x, spark, 10)
    n, k, lists = q.count(), 30, len(ix.centroids)
    a, pairs = vectorindex._pairs(ix, q, lists)
    near = vectorindex._near(ix, a, pairs, lists, k)
    assert "turned" not in near._jdf.queryExecution().executedPlan().toString()  # no query's vector for each list
    assert n * k <= near.count() <= n * k * 8  # 8 partitions
    a, pairs = vectorindex._pairs(ix, q, 6)
    monkeypatch.setattr(vectorindex, "HELD", 500)
    assert vectorindex._near(ix, a, pairs, 6, k).count() < 0.5 * sum(r.n for r in pairs.select((F.length("q") / 8 * F.length("rows") / 8).alias("n")).collect())


@pytest.mark.parametrize("probes", [3, 40, 54])
def test_both_ways_take_the_best_codes(spark, index, probes):
    x, rows, ix = index
    q = asked(x, spark, 300)
    a, pairs = vectorindex._pairs(ix, q, probes)
    got = retrieve.top(vectorindex._near(ix, a, pairs, probes, 25), 25, places=12, key="row", group="q").select("q", "row").collect()
    turn, blocks = vectorindex._rotation(ix.dims, ix.seed), {}
    for r in ix.lists.collect():
        n = np.frombuffer(r.rows, "<i8")
        blocks.setdefault(r.list, []).append((n, vectorindex.unpack_codes(np.frombuffer(r.codes, np.uint8).reshape(len(n), -1), np.frombuffer(r.scales, "<f4"), ix.dims)))
    for r in a.collect():
        v = np.array(r.v)
        with_c = ix.centroids @ v
        score = {int(i): s for at in np.argsort(-with_c, kind="stable")[:probes] for n, codes in blocks[at] for i, s in zip(n, codes @ (v @ turn) + with_c[at])}
        mine = [score[g.row] for g in got if g.q == r.q]
        assert np.allclose(sorted(mine, reverse=True), sorted(score.values(), reverse=True)[:25], atol=1e-6)


def test_a_report_counts_pairs_by_list(spark, index):
    x, rows, ix = index
    q = asked(x, spark, 10)
    a, pairs = vectorindex._pairs(ix, q, 5)
    got = vectorindex._compared(ix, a, 5)
    assert got.first().codes == sum(len(r.q) * len(r.rows) / 64 for r in pairs.select("q", "rows").collect())


def test_found_pairs_are_scored_without_their_vectors_in_a_row(spark, index):
    """A vector goes to the cells of a bounded grid, not to each pair."""
    x, rows, ix = index
    q = asked(x, spark, 7).withColumn("query_id", F.substring("query_id", 2, 9).cast("int"))  # keys of two types
    a, pairs = vectorindex._pairs(ix, q, 6)
    near = retrieve.top(vectorindex._near(ix, a, pairs, 6, 40), 40, places=12, key="row", group="q").select("q", "row").localCheckpoint()
    joined = near.join(ix.vectors.select("row", "doc_key", F.col("v").alias("w")), "row").join(a, "q").select("query_id", "doc_key", V.dot("v", "w").alias("score"))
    full = vectorindex._in_full(ix, a, near)
    assert full.dtypes == joined.dtypes and sorted(map(tuple, full.collect())) == sorted(map(tuple, joined.collect()))  # to the last bit
    plan = vectorindex.search(ix, q, 5, probes=40)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_many_queries_of_few_lists_meet_in_the_grid(spark, index, monkeypatch):
    x, rows, ix = index
    q = asked(x, spark, 2)
    want = sorted(map(tuple, vectorindex.search(ix, q, 5, probes=20).collect()))
    monkeypatch.setattr(vectorindex, "SENT", 0)
    a, pairs = vectorindex._pairs(ix, q, 20)
    assert "turned" not in vectorindex._near(ix, a, pairs, 20, 40)._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, vectorindex.search(ix, q, 5, probes=20).collect())) == want


def test_no_list_is_empty(spark, tmp_path):
    x = np.repeat(clustered(30), 10, axis=0)  # more centroids than distinct rows
    ix = vectorindex.build_vector_index(table(spark, x), f"file://{tmp_path}/v", n_lists=60)
    assert {r["list"] for r in ix.lists.collect()} == set(range(len(ix.centroids)))
