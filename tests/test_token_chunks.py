import json
import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import chunk
from textloom.plans.catalog import CATALOG

KIND = "doc_id long, pos int, level int, text string"


def fold(blocks, most):
    """The same by a walk over the blocks of one document: (path, n_tokens, chunk_text)."""
    path, out, last = {}, [], None
    for _, level, text in sorted(blocks, key=lambda b: b[0]):
        text = (text or "").strip()
        if level:
            path = {k: v for k, v in path.items() if k < level} | {level: text}
            continue
        if not text:
            continue
        heads = [h for _, h in sorted(path.items()) if h]
        lead = sum(len(h.split()) for h in heads)
        lead = lead if lead < most else 0
        room, words = most - lead, text.split()
        items = [(text, len(words))] if len(words) <= room else [(" ".join(words[i : i + room]), len(words[i : i + room])) for i in range(0, len(words), room)]
        for t, n in items:
            if last == heads and out[-1][1] + n <= most:
                out[-1] = (heads, out[-1][1] + n, out[-1][2] + "\n" + t)
            else:
                out.append((heads, lead + n, "\n".join([*(heads if lead else []), t])))
            last = heads
    return out


def chunks_of(spark, docs, most):
    df = spark.createDataFrame([(d, p, lv, t) for d, bs in docs.items() for p, lv, t in bs], KIND).repartition(4)
    got = {}
    for r in chunk.token_chunks(df, max_tokens=most).orderBy("doc_id", "chunk_index").collect():
        got.setdefault(r.doc_id, []).append((r.path, r.n_tokens, r.chunk_text))
        assert r.chunk_index == len(got[r.doc_id]) - 1
    return got


@pytest.mark.parametrize("most", [1, 5, 20, 256])
def test_as_a_walk_over_random_outlines(spark, most):
    rng = random.Random(most)
    docs = {}
    for d in range(60):
        docs[d] = [(p, rng.choice([None, 0, 0, 0, 0, 1, 2, 2, 3, 6]), " ".join(f"w{rng.randrange(99)}" for _ in range(rng.choice([0, 1, 3, 8, 40])))) for p in range(rng.randint(0, 14))]
    got = chunks_of(spark, docs, most)
    want = {d: c for d, bs in docs.items() if (c := fold(bs, most))}
    assert got == want
    for d, cs in got.items():
        assert all(n <= most for _, n, _ in cs)  # the budget
        told = " ".join(t if len(" ".join(p).split()) >= most else t[len("\n".join(p)) :] for p, _, t in cs).split()
        assert told == " ".join(t for _, lv, t in docs[d] if not lv).split()  # all words, in order


def test_peers_and_context(spark):
    docs = {1: [(0, 0, "before"), (1, 1, "A"), (2, 2, "B"), (3, 0, "x y"), (4, 0, "z"), (5, 2, "C"), (6, 0, "u"), (7, 1, "D"), (8, 0, "v"), (9, 3, "E"), (10, None, "w")]}
    assert chunks_of(spark, docs, 6)[1] == [([], 1, "before"), (["A", "B"], 5, "A\nB\nx y\nz"), (["A", "C"], 3, "A\nC\nu"), (["D"], 2, "D\nv"), (["D", "E"], 3, "D\nE\nw")]


def test_structure_and_no_rows(spark):
    made = json.dumps({"pages": [{"blocks": [{"text": "Head", "level": 1}, {"text": "a b"}]}, {"blocks": [{"text": "c"}, {"text": None}]}]})
    df = spark.createDataFrame([(1, made), (2, None), (3, "{")], "doc_id long, structure string")
    got = chunk.token_chunks(chunk.structure_blocks(df, "doc_id", "structure")).collect()
    assert [(r.doc_id, r.chunk_text, r.n_tokens) for r in got] == [(1, "Head\na b\nc", 4)]
    assert chunk.token_chunks(spark.createDataFrame([], KIND)).count() == 0
    with pytest.raises(ValueError):
        chunk.token_chunks(spark.createDataFrame([], KIND), max_tokens=0)


def test_catalog(spark, sf):
    got = CATALOG["token_chunks"].run(spark, sf)
    assert got.filter(F.col("n_tokens") > 256).count() == 0 and got.select("page_id").distinct().count() == 50
    semantic = CATALOG["semantic_chunks"].run(spark, sf)
    assert semantic.select("page_id").distinct().count() == 50 and semantic.filter(~F.startswith("chunk_text", F.lit("- "))).filter(F.length("chunk_text") > 1000).count() == 0
