import numpy as np

from textloom.llm import vectors


def brute(rows, least=0.98, kind=np.float64):
    def ok(e, label):
        return label is not None and e is not None and len(e) > 0 and all(x is not None and np.isfinite(x) for x in e) and any(e)

    n = {r[0]: 0 for r in rows}
    parent = {r[0]: r[0] for r in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    good = [(i, np.array(np.array(e, kind), float), y) for i, e, y in rows if ok(e, y)]
    for a, (i, x, y) in enumerate(good):
        for j, z, w in good[:a]:
            if y == w and len(x) == len(z) and x @ z / np.linalg.norm(x) / np.linalg.norm(z) >= least:
                n[i] += 1
                n[j] += 1
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
    return {i: (n[i], root(i), root(i) == i) for i, _, _ in rows}


def test_against_brute_force(spark):
    rng = np.random.default_rng(8)
    rows, k = [], 0
    for c in range(60):
        centre = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 12))):
            rows.append((k, (centre + rng.normal(size=16) * rng.choice([0.05, 0.15, 0.3])).tolist(), int(c % 3)))
            k += 1
    same = rows[5][1]
    for e, y in [(same, rows[5][2])] * 5 + [(None, 1), ([0.0] * 16, 1), ([float("nan")] + [1.0] * 15, 1), ([None] + [1.0] * 15, 1), ([float("inf")] * 16, 1), (same, None), (same[:8], rows[5][2]), (same[:8], rows[5][2]), ([], 1), ([x * 1e20 for x in same], rows[5][2])]:
        rows.append((k, e, y))
        k += 1
    rng.shuffle(rows)
    rows = [(int(i), e, y) for i, e, y in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for block in (7, 1024):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(df, block=block).collect()}
        assert got == brute(rows)
    few = df.withColumn("embedding", df.embedding.cast("array<float>"))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(few, block=30).collect()}
    assert got == brute(rows, kind=np.float32)


def test_the_limit_in_double_precision(spark):
    at = lambda c: [c, float(np.sqrt(1 - c * c))]
    rows = [(0, [1.0, 0.0], 0), (1, at(0.98 + 1e-12), 0), (2, [1.0, 0.0], 1), (3, at(0.98 - 1e-12), 1), (4, [3.0, 4.0], 2), (5, [3.0, 4.0], 2)]
    got = {r.vec_id: r.n_links for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {0: 1, 1: 1, 2: 0, 3: 0, 4: 1, 5: 1}


def test_hot_vector_and_chain(spark):
    axis = np.eye(8)
    rows = [(i, axis[0].tolist(), 0) for i in range(3000)]
    rows += [(5000 + i, (axis[1] * np.cos(0.19 * i) + axis[2] * np.sin(0.19 * i)).tolist(), 0) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in vectors.near_duplicates(df, block=5).collect()}
    assert all(got[i].n_links == 2999 and got[i].component_id == 0 for i in range(3000))
    assert all(got[5000 + i].component_id == 5000 for i in range(12)) and got[5000].n_links == 1 and got[5003].n_links == 2


def test_no_rows(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
