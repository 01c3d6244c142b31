import hashlib
import random
import re

from textloom.llm import minhash


def edited(texts, i):
    t, n = texts[i] or "", texts[(i + 1) % len(texts)] or ""
    half = len(t) // 2
    return t[: len(t) - half] + n[:half]


def jaccard(a, b, k=5):
    def grams(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()

    x, y = grams(a), grams(b)
    return 1.0 if not x and not y else len(x & y) / len(x | y)


def corpus():
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    texts = [None, "", "one", "你好 世界 🙂 naïve", " \n ", "w " * 4000]
    for _ in range(40):
        base = [word() for _ in range(rng.randint(30, 200))]
        texts.append(" ".join(base))
        if rng.random() < 0.5:
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    return texts + [texts[8]]


def test_fingerprints(spark):
    texts = corpus()
    order = list(range(len(texts)))
    random.Random(1).shuffle(order)
    docs = spark.createDataFrame([(i * 3, texts[i], True) for i in order], "doc_id long, text string, extra boolean")
    rows = {r.doc_id: r for r in minhash.fingerprints(docs).collect()}
    assert len(rows) == len(texts)
    by_text = {}
    for i, t in enumerate(texts):
        r = rows[i * 3]
        assert r.n_chars == len(t or "") and r.edited_sha256 == hashlib.sha256(edited(texts, i).encode()).hexdigest()
        assert by_text.setdefault(t or "", r.fingerprint) == r.fingerprint
        assert abs(r.near_edited - jaccard(t, edited(texts, i))) < 0.2
        assert abs(r.near_next - jaccard(t, texts[(i + 1) % len(texts)])) < 0.2


def test_ties_single_and_no_rows(spark):
    kind = "doc_id long, text string"
    one = minhash.fingerprints(spark.createDataFrame([(7, "abcd")], kind)).collect()
    assert len(one) == 1 and one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    tied = minhash.fingerprints(spark.createDataFrame([(1, "bb"), (1, "aa"), (None, "cc"), (1, "aa")], kind)).collect()
    assert sorted(r.edited_sha256 for r in tied) == sorted(hashlib.sha256(x).hexdigest() for x in (b"ca", b"aa", b"ab", b"bc"))
    assert minhash.fingerprints(spark.createDataFrame([], kind)).count() == 0


def test_near_duplicates_against_brute_force(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, item string")
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if jaccard(texts[i], texts[j]) >= 0.8 and bool((texts[i] or "").strip()) == bool((texts[j] or "").strip()) and ((texts[i] or "").strip() or (texts[i] or "") == (texts[j] or "") or True):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    assert got == {i: root(i) for i in range(len(texts))}


def test_near_duplicates_nulls_and_no_rows(spark):
    kind = "doc_id long, text string, key string"
    rows = [(None, "a b c d e f", "k"), (4, "a b c d e f", "k"), (4, "A b c d e f", "k"), (4, "other words here", None), (9, None, "k"), (7, "", "k"), (None, "quite alone", "k")]
    got = [(r.doc_id, r.class_id) for r in minhash.near_duplicates(spark.createDataFrame(rows, kind)).collect()]
    assert sorted(got, key=str) == sorted([(None, 4), (4, 4), (4, 4), (4, 4), (9, 7), (7, 7), (None, None)], key=str)
    assert minhash.near_duplicates(spark.createDataFrame([], kind)).count() == 0


def test_blocks_of_long_texts_do_not_matter(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(3)
    begin = np.concatenate([[0], np.cumsum(rng.choice([0, 1, 5, 40, 300], 60))])
    x = rng.integers(0, 2**63, begin[-1], dtype=np.uint64)
    whole = minhash.signatures(x, begin, 16)
    a, b = minhash.coefficients(16)
    with np.errstate(over="ignore"):
        for i in (0, 7, 30, 59):
            part = x[begin[i] : begin[i + 1]]
            want = [int((part * a[k] + b[k]).min() >> np.uint64(32)) & 0xFFFF if len(part) else 0xFFFF for k in range(16)]
            assert whole[i].tolist() == want
    monkeypatch.setattr(minhash, "BLOCK", 64)
    assert (minhash.signatures(x, begin, 16) == whole).all()
