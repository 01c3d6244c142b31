import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from textloom.llm import suffix
from textloom.llm.shared import text_key


def removed(texts, length):
    """For each text, which of its bytes go."""
    seen = defaultdict(list)
    raw = [(t or "").encode() for t in texts]
    for i, r in enumerate(raw):
        for s in range(len(r) - length + 1):
            seen[r[s : s + length]].append((i, s))
    gone = [bytearray(len(r)) for r in raw]
    for where in seen.values():
        if len(where) > 1:
            for i, s in where:
                gone[i][s : s + length] = b"\x01" * length
    return gone


def brute(texts, length):
    out = []
    for r, g in zip([(t or "").encode() for t in texts], removed(texts, length)):
        spans = sum(1 for i in range(len(g)) if g[i] and (i == 0 or not g[i - 1]))
        out.append((len(r), sum(g), spans, hashlib.sha256(bytes(b for b, x in zip(r, g) if not x)).hexdigest()))
    return out


def corpus(seed, length):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé€ ") for _ in range(rng.randint(1, 9)))
    body = lambda n: " ".join(word() for _ in range(n))
    shared = [body(length // 2) for _ in range(4)]
    texts = [None, "", "x", body(3), "a" * (length * 3), "a" * (length - 1), "ab" * length]
    for _ in range(40):
        parts = [body(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s))
            parts += [s[a : a + rng.randint(0, 2 * length)], body(rng.randint(0, 20))]
        texts.append("".join(parts))
    texts += [texts[10], texts[10], texts[11] + "!", texts[12][5:]]
    return texts


def found(spark, texts, length, group=suffix.GROUP):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, k string")
    out = suffix.remove_repeats(docs.select("doc_id", "text"), length, group)
    rows = docs.select("doc_id", *text_key(docs.text)).join(out, ["k1", "k2"]).orderBy("doc_id").collect()
    return [(r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in rows]


@pytest.mark.parametrize("length,group", [(20, 1 << 14), (40, 1 << 14), (40, 3), (200, 1 << 14), (200, 2)])
def test_against_brute_force(spark, length, group):
    texts = corpus(length + group, length)
    assert found(spark, texts, length, group) == brute(texts, length)


@pytest.mark.parametrize("alphabet", ["\0ab", "\0\x01\u07ff", "abc"])
@pytest.mark.parametrize("length", [20, 50, 200])
def test_any_byte(spark, alphabet, length):
    rng = random.Random(length)
    base = ["".join(rng.choice(alphabet) for _ in range(3 * length)) for _ in range(4)]
    texts = []
    for i in range(48):  # near copies
        t = list(base[i % 4])
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(len(t))] = rng.choice(alphabet)
        texts.append("".join(t)[rng.randint(0, 9) :])
    want = brute(texts, length)
    assert 0 < sum(r[1] for r in want) < sum(r[0] for r in want)
    assert found(spark, texts, length) == want == found(spark, texts, length, 2)


def test_boundaries_are_short_common_prefixes():
    rng = np.random.default_rng(5)
    text = rng.integers(97, 100, 3000).astype(np.uint8)
    text[1000:1400] = text[200:600]
    text[-1] = 0
    order = suffix.suffix_order(text, 32)
    raw = text.tobytes()
    apart = suffix.boundaries(text, order, 20)
    for i in range(1, len(order)):
        a, b = raw[order[i - 1] : order[i - 1] + 20], raw[order[i] : order[i] + 20]
        assert apart[i] == (a != b)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffix.remove_repeats(docs).count() == 0


def test_whole_code_points(spark):
    shared = "\ufffdé€" * 30
    texts = ["a" + shared + "b\ufffd", "\u00c9" + shared[1:] + "\ufffdx", "€" * 5]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {bytes(r.text).decode(): bytes(r.kept) for r in docs.select(*text_key(docs.text), docs.text.cast("binary").alias("text")).join(suffix.remove_repeats(docs, 20, points=True), ["k1", "k2"]).collect()}
    for t, gone in zip(texts, removed(texts, 20)):
        raw, want, at = t.encode(), "", 0
        for c in t:
            n = len(c.encode())
            want += c if not any(gone[at : at + n]) else ""
            at += n
        assert got[t].decode() == want
        assert at == len(raw)
