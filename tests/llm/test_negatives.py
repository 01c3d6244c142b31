import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import negatives
from textloom.llm.queries import QUERIES

KIND = "vec_id long, embedding array<double>, label long"


def brute(rows, every, positives=5, k=5, low=80, high=100):
    ok = [(i, [math.floor(256 * x) for x in e], y) for i, e, y in rows if i is not None and y is not None and e and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, a, y in ok:
        if i % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(a, b)), j, z) for j, b, z in ok if len(a) == len(b))
        for s, j, _ in [r for r in scored if r[2] == y and r[1] != i][:positives]:
            fit = [r for r in scored if r[2] != y and low * -s <= high * -r[0] <= high * -s][:k]
            out += [(i, j, n + 1, r[1], -s, -r[0]) for n, r in enumerate(fit)]
    return sorted(out)


def mined(df, every, **options):
    got = negatives.hard_negatives(df, F.col("vec_id") % every == 0, **options)
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def table(seed, n, dims=6, labels=3, spread=40):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, dims)) + 1, 2)
    x[rng.integers(0, n, n // spread)] = x[0]  # ties
    return [(int(i), x[i].tolist(), int(rng.integers(labels))) for i in rng.permutation(n)]


@pytest.mark.parametrize("block,anchors,group", [(2048, 256, 32), (50, 7, 2), (1, 1, 1)])
def test_against_brute_force(spark, monkeypatch, block, anchors, group):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "ANCHORS", anchors)
    monkeypatch.setattr(negatives, "GROUP", group)
    rows = table(11, 400 if block > 1 else 60)
    want = brute(rows, 10)
    assert len(want) > 50 and mined(spark.createDataFrame(rows, KIND).repartition(3), 10) == want


def test_limits_are_exact(spark):
    """Scores at both limits and one beside them, also for products that are no multiples."""
    one = lambda s: [s / 256, 0.0]
    rows = [(0, one(1), 1), (1, one(101), 1), (2, one(7), 1), (3, one(-9), 1)] + [(10 + s, one(s), 0) for s in (-9, -8, 4, 5, 6, 7, 8, 80, 81, 82, 100, 101, 102)]
    want = brute(rows, 100, k=20)
    assert mined(spark.createDataFrame(rows, KIND), 100, negatives=20) == want
    assert [(r[1], r[3]) for r in want] == [(1, 111), (1, 110), (1, 92), (1, 91), (2, 17), (2, 16)]


def test_nulls_repeats_lengths_and_extra_columns(spark):
    rows = table(5, 80) + [(None, [1.0] * 6, 1), (90, None, 1), (100, [1.0] * 6, None), (110, [float("nan")] * 6, 1), (120, [None] + [1.0] * 5, 1), (130, [float("inf")] * 6, 0), (140, [], 1)]
    rows += [(150, [1.0, 2.0], 1), (151, [1.0, 2.0], 1), (152, [1.0, 1.9], 0)] + [table(5, 80)[3]] * 2
    want = brute(rows, 10)
    df = spark.createDataFrame(rows, KIND).withColumn("rank", F.lit("x")).withColumn("key", F.lit(1)).withColumn("v", F.lit(None).cast("int"))
    assert any(r[0] == 150 for r in want) and mined(df, 10) == want


def test_a_hot_label_and_equal_vectors(spark):
    rows = [(i, [1.0, 0.5], 0 if i % 3 else 1) for i in range(600)]
    assert mined(spark.createDataFrame(rows, KIND), 100) == brute(rows, 100)


def test_large_components(spark):
    big = 65535.0
    rows = [(0, [big] * 4, 0), (1, [big, big, big, -big], 0), (2, [big, big, big, 1.0], 1), (3, [-big] * 4, 1), (4, [big / 2] * 4, 1)]
    want = brute(rows, 100)
    assert want and mined(spark.createDataFrame(rows, KIND), 100) == want
    with pytest.raises(Exception, match="component"):
        mined(spark.createDataFrame([*rows, (5, [1e30] * 4, 1)], KIND), 100)


def test_no_rows_and_no_anchor(spark):
    assert mined(spark.createDataFrame([], KIND), 100) == []
    assert mined(spark.createDataFrame(table(1, 30), KIND).filter("vec_id > 0"), 100) == []


def test_query_has_rows(spark, sf):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows, 100)
    got = QUERIES["op11_hard_negatives"](spark, sf).collect()
    assert want and sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got) == want
