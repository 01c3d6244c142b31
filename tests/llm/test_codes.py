import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import codes

KIND = "vec_id long, embedding array<double>, label long"


def brute(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * x) for x in e], y) for i, e, y in rows if e and all(x is not None and math.isfinite(x) for x in e)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dims = len(first[0][1])
    fit = [r for r in first if len(r[1]) == dims]
    w = dims // parts
    book = [[r[1][p * w : p * w + w] for r in fit[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(book[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = [[] for _ in book[p]]
            for _, v, _ in fit:
                own[nearest(p, v[p * w : p * w + w])[1]].append(v[p * w : p * w + w])
            book[p] = [[sum(c) // len(xs) for c in zip(*xs)] if xs else old for xs, old in zip(own, book[p])]
    text = hashlib.sha256(",".join(str(x) for b in book for c in b for x in c).encode()).hexdigest()
    out = []
    for i, v, y in kept:
        got = [nearest(p, v[p * w : p * w + w]) for p in range(parts)] if len(v) == dims else None
        out.append((i, y, got and "".join(f"{k:02x}" for _, k in got), got and sum(d for d, _ in got)))
    sums = {}
    for _, y, _, e in out:
        sums[y] = sums.get(y, 0) + e if e is not None else sums.get(y)
    return sorted(((i, c, e, sums[y], text) for i, y, c, e in out), key=repr)


def compressed(df, **options):
    return sorted((tuple(r) for r in codes.compress(df, **options).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def table(seed, n, dims=32):
    rng = np.random.default_rng(seed)
    return [(int(i), rng.normal(size=dims).tolist(), None if i % 5 == 0 else int(i % 3)) for i in rng.permutation(n)]


@pytest.mark.parametrize("block,n", [(1024, 300), (7, 90)])
def test_against_brute_force(spark, monkeypatch, block, n):
    monkeypatch.setattr(codes, "BLOCK", block)
    rows = table(13, n)
    assert compressed(spark.createDataFrame(rows, KIND).repartition(4)) == brute(rows)


def test_other_sizes(spark):
    rows = table(2, 60, 12)
    assert compressed(spark.createDataFrame(rows, KIND), parts=3, entries=5, rounds=4) == brute(rows, 3, 5, 4)
    with pytest.raises(ValueError, match="equal parts"):
        codes.compress(spark.createDataFrame(rows, KIND), parts=5)


def test_ties_go_to_the_lower_entry_and_unused_entries_stay(spark):
    rows = [(i, [(i % 4) / 256] * 16, 0) for i in range(80)] + [(100, [1 / 512] * 16, 1)]
    got = compressed(spark.createDataFrame(rows, KIND))
    assert got == brute(rows) and {r[1] for r in got} == {f"{k:02x}" * 16 for k in range(4)}


def test_nulls_repeats_lengths_and_extra_columns(spark):
    rows = table(4, 50) + [(None, table(9, 1)[0][1], 1), (3, None, 1), (60, [float("nan")] * 32, 1), (61, [None] * 32, 1), (62, [float("-inf")] * 32, None), (63, [], 1), (64, [1.0] * 16, 1), (65, [1.0] * 48, 7), (65, [1.0] * 48, 7)]
    rows += [table(4, 50)[0]] * 3
    df = spark.createDataFrame(rows, KIND).withColumn("code", F.lit(1)).withColumn("error", F.lit("x")).withColumn("v", F.lit(0))
    got = compressed(df)
    assert got == brute(rows) and sum(r[1] is None for r in got) == 3


def test_few_vectors_and_none(spark):
    rows = table(6, 9)
    assert compressed(spark.createDataFrame(rows, KIND)) == brute(rows)
    empty = codes.compress(spark.createDataFrame([], KIND))
    assert empty.count() == 0 and empty.columns == codes.compress(spark.createDataFrame(rows, KIND)).columns
    assert compressed(spark.createDataFrame([(1, None, 1), (2, [float("nan")], 2)], KIND)) == []


def test_large_components(spark):
    rows = [(i, [(-1) ** (i + j) * 65535.0 for j in range(32)], 0) for i in range(70)]
    assert compressed(spark.createDataFrame(rows, KIND), entries=1, rounds=1) == brute(rows, entries=1, rounds=1)
    with pytest.raises(Exception, match="component"):
        compressed(spark.createDataFrame([*rows, (99, [1e30] * 32, 1)], KIND))


def test_a_hot_label(spark):
    rows = [(i, [i % 11 / 10] * 16, None) for i in range(3000)]
    got = codes.compress(spark.createDataFrame(rows, KIND))
    assert got.select("label_error").distinct().count() == 1 and got.count() == 3000
