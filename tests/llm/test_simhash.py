import random

import numpy as np
import xxhash

from textloom.llm import simhash


def brute_fingerprint(text, k=4):
    import re

    words = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    if not words:
        return 0
    grams = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(ids, fps, radius=4):
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        least[root(i)] = min(d, least.get(root(i), d))
    return {d: least[root(i)] for i, d in enumerate(ids)}


def test_documents_against_brute_force(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcÉ") for _ in range(rng.randint(1, 4)))
    texts = [None, "", " \t\n", "One", "one two", "A b  c\nD", "x" * 5000]
    for _ in range(30):
        base = [word() for _ in range(rng.randint(20, 200))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    texts += texts[8:12]
    docs = spark.createDataFrame([(i * 7 % 1000, t, "e") for i, t in enumerate(texts)], "doc_id long, text string, fingerprint string")
    rows = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert len(rows) == len(texts)
    fps = {i * 7 % 1000: brute_fingerprint(t) for i, t in enumerate(texts)}
    assert {k: r.fingerprint & (2**64 - 1) for k, r in rows.items()} == fps
    assert {k: r.component_id for k, r in rows.items()} == brute_components(list(fps), list(fps.values()))


def test_no_link_is_lost(spark):
    rng = np.random.default_rng(4)
    f = []
    for _ in range(150):
        x = int(rng.integers(0, 2**63))
        f.append(x)
        for _ in range(int(rng.integers(0, 5))):
            for b in rng.choice(64, int(rng.integers(1, 6)), replace=False):
                x ^= 1 << int(b)
            f.append(x)
    hub = int(rng.integers(0, 2**63))  # one large group of near copies
    f += [hub ^ (1 << int(a)) ^ (1 << int(b)) for a in range(64) for b in range(a)]
    f = sorted({x - 2**64 if x >= 2**63 else x for x in f})
    got = {r.node: r.component for r in simhash.near(spark.createDataFrame([(x,) for x in f], "f long")).collect()}
    want = brute_components(f, [x & (2**64 - 1) for x in f])
    assert {x: got.get(x, x) for x in f} == want


def test_no_rows(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_large_cells_are_divided(spark, monkeypatch):
    rng = np.random.default_rng(9)
    half = int(rng.integers(0, 2**32))
    f = [int(x) << 32 | half for x in rng.integers(0, 2**31, 1500)]  # one cell, few links
    f += [x ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for x in f[:200] for a, b, c in [rng.choice(63, 3, replace=False)]]
    f += [int(x) for x in rng.integers(0, 2**63, 300)]
    f = np.unique(np.array(f, np.uint64))
    near = [np.flatnonzero(np.bitwise_count(f ^ x) <= 4) for x in f]
    parent = np.arange(len(f))
    for _ in range(len(f)):
        new = np.array([parent[n].min() for n in near])
        if (new == parent).all():
            break
        parent = new
    assert len(set(parent.tolist())) < len(f)
    for large in (4, 64, 256):
        monkeypatch.setattr(simhash, "LARGE", large)
        cell, who = simhash.cells(f)
        x, root = simhash.links(cell, f[who], 4)
        got = dict(zip(x, root))
        assert [got.get(v, v) for v in f.tolist()] == f[parent].tolist()
