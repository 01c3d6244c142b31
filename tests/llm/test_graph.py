import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textloom.llm import graph


def brute(edges):
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def chain(n):
    ids = random.Random(n).sample(range(10 * n), n)
    return list(zip(ids, ids[1:]))


SHAPES = {
    "none": [],
    "self": [(3, 3), (1, 2)],
    "star": [(5000, i) for i in range(600)] + [(-7, i) for i in range(300, 900)],
    "chain": chain(90),
    "random": [tuple(random.Random(i).sample(range(400), 2)) for i in range(260)] * 2,
}


@pytest.mark.parametrize("shape", SHAPES)
def test_against_union_find(spark, shape):
    edges = SHAPES[shape]
    rows = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(rows) == len({r.node for r in rows})
    assert {r.node: r.component for r in rows} == brute([e for e in edges if e[0] != e[1]])


def test_a_hub_is_dealt_to_many_places(spark):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "50"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        n = 20_000
        rows = spark.range(n).select(F.when(F.col("id") % 3 > 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
        joined = graph.hub_join(rows, rows.groupBy("k").agg(F.count("*").alias("n")), "k", "v")
        sizes = Counter(r[0] for r in joined.select(F.spark_partition_id()).collect())
        assert sum(sizes.values()) == n and max(sizes.values()) < 3 * n / 50
        assert joined.filter("k = -1 and n <> 13333").count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
