import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import toxicity
from textloom.llm.shared import text_key


def corpus(n=600, seed=4):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["ba", "do", "ki", "lu", "mé", "sen"]) for _ in range(rng.randint(1, 4)))
    bad = ["grumph", "blarg", "snerk", "toxilu", "toxiba", "toxido"]
    rows = []
    for i in range(n):
        toxic = int(rng.random() < 0.25)
        words = [word() for _ in range(rng.randint(5, 80))]
        if toxic:
            for _ in range(rng.randint(2, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(bad).upper() + "!")
        rows.append((i, " ".join(words), toxic))
    return rows


def test_held_out_documents(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "label") for i, t, _ in rows] + [(9000, None, ""), (9001, "", ""), (9002, "x " * 30000, "")], "doc_id long, text string, label string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3] + [(5, None), (None, 1), (123456, 1)] + [(i, y) for i, _, y in rows[:9] if i % 3], "doc_id long, toxic int")
    scorer = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, scorer, [F.col("doc_id")]).collect()}
    test = [(got[i].score, got[i].predicted, y) for i, _, y in rows if i % 3 == 0]
    assert np.mean([p == y for _, p, y in test]) > 0.95
    assert all(0 <= s <= 1 for s, _, _ in test) and abs(np.mean([s for s, _, _ in test]) - np.mean([y for *_, y in test])) < 0.08
    assert got[9000].score == got[9001].score < 0.5 and got[9002].predicted == 0
    toxic = next(i for i, _, y in rows if y and i % 3 == 0)
    assert got[toxic].evidence and all(rows[j][0] == j for j in got[toxic].evidence)


def test_blocks_lose_no_neighbour(monkeypatch):
    monkeypatch.setattr(toxicity, "DENSE", 20)
    rng = np.random.default_rng(6)
    n, f = 500, 60
    dense = rng.random((n, f)) * (rng.random((n, f)) < 0.08)
    dense = dense[dense.any(1)]
    dense = np.concatenate([dense, dense[:40]])  # ties
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    row, col = np.nonzero(dense)
    index = toxicity.Index(len(dense), f, row, col, dense[row, col])
    for but in (None, np.arange(len(dense))):
        text, example, cosine = index.nearest(row, col, dense[row, col], len(dense), 10, but)
        for i in range(len(dense)):
            want = np.round(dense @ dense[i], 12)
            if but is not None:
                want[i] = 0
            order = np.lexsort((np.arange(len(want)), -want))[:10]
            order = order[want[order] > 0]
            assert example[text == i].tolist() == order.tolist() and np.allclose(cosine[text == i], want[order])


def brute_terms(text):
    """Words, and prefixes of longer words by their length."""
    out = Counter()
    for w in re.findall(rb"[a-z\x80-\xff]+", text.encode()):
        out[w, 0] += 1
        for n in toxicity.PREFIXES:
            if len(w) > n:
                out[w[:n], n] += 1
    return out


def brute_shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_scores(docs, labels, hashes, per_class, k):
    """docs: doc_id -> lower-cased text; labels: (doc_id, toxic); hashes: text -> order."""
    of = defaultdict(list)
    for i, y in labels:
        if zlib.crc32(str(i).encode()) % 5 and i in docs and y in (0, 1):
            of[docs[i]].append(y)
    mean = {t: sum(y) / len(y) for t, y in of.items()}
    rank = sorted(mean, key=hashes.get)
    sides = [[t for t in rank if mean[t] < 0.5], [t for t in rank if mean[t] >= 0.5]]
    counts, sample = [len(s) for s in sides], sorted(sides[0][:per_class] + sides[1][:per_class], key=hashes.get)
    prior = counts[1] / sum(counts)
    sets = [brute_shingles(t) for t in sample]
    group = list(range(len(sample)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a & b and len(a & b) >= 0.8 * len(a | b) and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    first = sorted(set(group))
    y = np.array([np.mean([mean[t] for t, g in zip(sample, group) if g == f]) for f in first])
    bags = [brute_terms(sample[f]) for f in first]
    terms = {t: n for n, t in enumerate(dict.fromkeys(t for b in bags for t in b))}
    df = Counter(t for text in docs.values() for t in brute_terms(text) if t in terms)
    n = Counter(t for b in bags for t in b)
    hit = Counter()
    for b, v in zip(bags, y):
        for t in b:
            hit[t] += v
    rate = y.mean()
    weight = np.zeros(len(terms))
    for t, c in terms.items():
        p, gain = hit[t] / n[t], 0.0
        if p > rate:
            gain = n[t] * (p * math.log(p / rate) + (1 - p) * math.log((1 - p) / (1 - rate)) if p < 1 else -math.log(rate))
        weight[c] = math.log((1 + len(docs)) / (1 + df[t])) * (1 + max(0, gain - math.log(len(terms) / toxicity.ALPHA)))

    def vector(bag):
        v = np.zeros(len(terms))
        for t, c in bag.items():
            if t in terms:
                v[terms[t]] = (1 + math.log(c)) * weight[terms[t]]
        return v / (np.linalg.norm(v) or 1)

    examples = np.array([vector(b) for b in bags])

    def vote(v, but=None):
        cos = np.round(examples @ v, 12)
        if but is not None:
            cos[but] = 0
        near = [i for i in np.lexsort((np.arange(len(cos)), -cos))[:k] if cos[i] > 0]
        return sum(cos[i] * y[i] for i in near) / (sum(cos[i] for i in near) + 1) if near else None

    left = [vote(v, i) for i, v in enumerate(examples)]
    share = [counts[0] / (1 - y).sum(), counts[1] / y.sum()]
    w = share[1] * y + share[0] * (1 - y)
    blank = [i for i, v in enumerate(left) if v is None]
    none = (sum(w[i] * y[i] for i in blank) + prior) / (sum(w[i] for i in blank) + 1)
    xs = sorted({v for v in left if v is not None})
    at = [[i for i, v in enumerate(left) if v == x] for x in xs]
    cum = [(sum(w[i] for i in a), sum(w[i] * y[i] for i in a)) for a in at]
    # the increasing fit at j: the largest over starts of the least over ends of means
    mean_of = lambda s, e: sum(c[1] for c in cum[s : e + 1]) / sum(c[0] for c in cum[s : e + 1])
    fit = [max(min(mean_of(s, e) for e in range(j, len(xs))) for s in range(j + 1)) for j in range(len(xs))]
    level = defaultdict(int)
    for j, f in enumerate(fit):
        level[round(f, 9)] += len(at[j])
    knots = [(f * level[round(f, 9)] + prior) / (level[round(f, 9)] + 1) for f in fit]
    knots = np.maximum.accumulate(knots)
    out = {}
    for i, t in docs.items():
        v = vote(vector(brute_terms(t)))
        out[i] = none if v is None else float(np.interp(v, xs, knots))
    return out


def test_query_against_brute_force(spark, tmp_path):
    rows = corpus(260, 9)
    docs = {i: t.lower() for i, t, _ in rows} | {900: "", 901: "", 902: "1 2 3", 903: rows[3][1].lower()}
    labels = [(i, y) for i, _, y in rows] + [(900, 0), (903, 1 - rows[3][2]), (902, 0), (7, 5), (99999, 1)]
    copies = {1000 + i: docs[i] + " zuzu" for i in range(40, 60)}  # near copies, some with the other label
    docs |= copies
    labels += [(i, rows[i - 1000][2] if i % 3 else 1 - rows[i - 1000][2]) for i in copies]
    spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    frame = spark.createDataFrame([(t,) for t in set(docs.values())], "text string").select("text", *text_key(F.col("text")))
    hashes = {r.text: (r.k1, r.k2) for r in frame.collect()}
    for per_class in (1000, 30):
        table = spark.read.parquet(f"{tmp_path}/documents.parquet")
        known = spark.read.parquet(f"{tmp_path}/labels.parquet").filter(~toxicity.held_out(F.col("doc_id")))
        got = {r.doc_id: r.score for r in toxicity.score(table, toxicity.fit(table, known, per_class), [F.col("doc_id")]).collect()}
        want = brute_scores(docs, labels, hashes, per_class, toxicity.NEIGHBOURS)
        assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in want) < 1e-6
        if per_class == toxicity.PER_CLASS:
            asked = toxicity.query(spark, str(tmp_path)).collect()
            assert {r.doc_id: r.score for r in asked} == got
            assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in asked)


def test_doc_id_is_no_input(spark):
    rows = corpus(200, 3)
    frame = lambda f: spark.createDataFrame([(f(i), t) for i, t, _ in rows], "doc_id long, text string")
    marked = lambda f: spark.createDataFrame([(f(i), y) for i, _, y in rows], "doc_id long, toxic int")
    scores = []
    for f in (lambda i: i, lambda i: 5000 - 7 * i):
        got = toxicity.score(frame(f), toxicity.fit(frame(f), marked(f), 40), [F.col("doc_id")]).collect()
        scores.append({r.doc_id: r.score for r in got})
    assert [scores[0][i] for i, _, _ in rows] == [scores[1][5000 - 7 * i] for i, _, _ in rows]


def test_names_that_clash(spark):
    docs = spark.createDataFrame([(1, "a b", 0.5)], "doc_id long, text string, score double")
    scorer = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    with pytest.raises(ValueError):
        toxicity.score(docs, scorer, [F.col("score")])


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.score(docs, toxicity.fit(docs, none), [F.col("doc_id")]).collect()] == [0, 0]
    clean = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    assert [r.predicted for r in toxicity.score(docs, toxicity.fit(docs, clean), [F.col("doc_id")]).collect()] == [0, 0]
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), none), [F.col("doc_id")]).count() == 0


def test_monotone_fit():
    x, y = toxicity.monotone(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0, 1, 0, 1.0]), np.ones(4), 0.5)
    assert (np.diff(y) >= 0).all() and (np.diff(x) >= 0).all()
