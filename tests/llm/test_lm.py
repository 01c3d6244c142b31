import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import lm
from textloom.llm import words as W

END, START = "\x00END", "\x00START"


def tokens(text):
    lowered = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    return [w.decode() for w in re.findall(rb"[^\x20\x09-\x0D]+", lowered)] + [END]


class Brute:
    """The same model from dictionaries."""

    def __init__(self, texts):
        rows = [tokens(t) for t in texts]
        self.c = Counter(w for r in rows for w in r)
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.pairs = Counter(p for r in rows for p in zip([START, *r], r))
        self.before = Counter(w for _, w in self.pairs)
        self.context = Counter()
        for (u, _), k in self.pairs.items():
            self.context[u] += k
        self.low, self.high = (lm.discounts(*(sum(x == k for x in c.values()) for k in (1, 2, 3, 4))) for c in (self.before, self.pairs))

    def unigram(self, w):
        a, types = self.before[w], len(self.pairs)
        if not types:
            return 1 / (self.v + 1)
        left = sum(self.low[min(x, 3) - 1] for x in self.before.values()) / types
        return max(a - (self.low[min(a, 3) - 1] if a else 0), 0) / types + left / (self.v + 1)

    def score(self, text):
        row, total = tokens(text), 0.0
        base = sum(math.log10((self.c[w] + 1) / (self.n + 1 * (self.v + 1))) for w in row)
        for u, w in zip([START, *row], row):
            p, all_ = self.unigram(w), self.context[u]
            if all_:
                k = self.pairs[u, w]
                left = sum(self.high[min(x, 3) - 1] for (s, _), x in self.pairs.items() if s == u) / all_
                p = max(k - (self.high[min(k, 3) - 1] if k else 0), 0) / all_ + left * p
            total += math.log10(p)
        return len(row), sum(self.c[w] > 0 for w in row), base, total


def corpus():
    rng = random.Random(3)
    words = ["a", "B", "the", "É", "naïve", "x1", "dog", "Cat", "z" * 30]
    texts = [None, "", "  \n\t", "A b", "unseen words here"] + [" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(40)]
    return texts + texts[5:8] + ["the " * 3000]


def test_scores_against_dictionaries(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, 1.0, 2) for i, t in enumerate(texts)], "doc_id long, text string, score double, n_tokens int")
    model = lm.fit(docs.filter("doc_id <> 4 and doc_id % 3 <> 1"))
    brute = Brute([t for i, t in enumerate(texts) if i != 4 and i % 3 != 1])
    assert (model["n"], model["v"]) == (brute.n, brute.v)
    rows = {r.doc_id: r for r in lm.score(docs, model, [F.col("doc_id")]).collect()}
    for i, t in enumerate(texts):
        n, known, base, score = brute.score(t)
        assert (rows[i].n_tokens, rows[i].n_known) == (n, known)
        assert rows[i].base_score == pytest.approx(base, rel=1e-9) and rows[i].score == pytest.approx(score, rel=1e-9)


def test_probabilities_sum_to_one():
    brute = Brute(corpus())
    for u in ("the", "a", START):
        left = sum(brute.high[min(x, 3) - 1] for (s, _), x in brute.pairs.items() if s == u) / brute.context[u]
        seen = sum(max(k - brute.high[min(k, 3) - 1], 0) / brute.context[u] for (s, _), k in brute.pairs.items() if s == u)
        assert seen + left * (sum(brute.unigram(w) for w in brute.c) + brute.unigram("never seen")) == pytest.approx(1)


def test_empty_training_set(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    model = lm.fit(docs.limit(0))
    row = lm.score(docs, model, [F.col("doc_id")]).first()
    assert model["v"] == 0 and row.n_tokens == 3 and row.n_known == 0 and row.score == 0
    assert lm.score(docs.limit(0), model, [F.col("doc_id")]).count() == 0


def test_held_out_perplexity_beats_base(spark, sf):
    rows = lm.query(spark, sf).filter("held_out").agg(F.sum("score"), F.sum("base_score"), F.count("*")).first()
    assert rows[2] > 0 and rows[0] > rows[1]


def test_words_are_those_of_the_pattern():
    import pyarrow as pa

    texts = ["One  TWO\tthree\x0b", "", None, "É é x\x1fy", "z"]
    data, offsets = W.buffers(pa.array(texts))
    h, first = W.words(data, offsets)
    want = [tokens(t)[:-1] for t in texts]
    assert np.diff(first).tolist() == [len(w) for w in want]
    flat = [w for r in want for w in r]
    assert len({int(x) for x in h}) == len(set(flat)) and len(dict(zip(flat, h.tolist()))) == len(set(flat))
