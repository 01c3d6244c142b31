import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from textloom.llm import lines, simhash, suffix, toxicity
from textloom.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append((docs, docs := stage(spark, docs, sf).cache()))
    return out


def test_columns_stay(stages, spark, sf):
    kinds = spark.read.parquet(f"{sf}/documents.parquet").dtypes
    assert all(after.dtypes == kinds for _, after in stages[:-1])


def test_toxic_rows_go(spark):
    sf = "/root/testdata/sf0.01"
    before = spark.read.parquet(f"{sf}/documents.parquet")
    after = corpus_pipeline.drop_toxic(spark, before, sf)
    scored = toxicity.score(before, toxicity.learned(before, sf), [F.col("doc_id")])
    want = {r.doc_id for r in scored.filter("predicted = 0").collect()}
    assert {r.doc_id for r in after.collect()} == want and 0 < len(want) < before.count()


def test_lines_are_cut_but_no_row(stages):
    before, after = stages[1]
    kept = {r.doc_id: r.kept for r in lines.dedup_lines(before).select("row.doc_id", "kept").collect()}
    assert {r.doc_id: r.text for r in after.collect()} == kept
    assert after.filter("n_chars <> length(text)").count() == 0


def test_one_of_each_class_stays(stages):
    before, after = stages[2]
    want = {r.component_id for r in simhash.near_duplicates(before).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(want)


def test_repeats_go(stages):
    before, after = stages[3]
    assert before.count() == after.count() and after.filter("text is null").count() == 0
    again = suffix.remove_repeats(after.select("text")).filter("n_bytes >= 200").agg(F.sum("n_removed"), F.sum("n_bytes")).first()
    first = suffix.remove_repeats(before.select("text")).agg(F.sum("n_removed")).first()
    assert first[0] > 0 and (again[0] or 0) <= first[0]


def test_all_tokens_are_packed(stages):
    before, after = stages[4]
    assert {r.doc_id for r in after.select("doc_id").distinct().collect()} == {r.doc_id for r in before.collect()}
    assert after.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0


def test_run_and_registry(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if re.match(r"op\d", n)) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_simhash_stage_with_nulls_and_repeats(spark, sf):
    rows = [(None, "a b c d e", "en", "s", 9), (3, "a b c d e", "en", "s", 9), (3, "a b c d e", "en", "s", 9), (4, None, "en", "s", 0), (5, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_copies(spark, docs, sf)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [3, 4]


def test_simhash_stage_keeps_one_row_of_each_class(spark, sf):
    x, y, z, v, w = (" ".join(f"{c}{i * i % 97}" for i in range(60)) for c in "xyzvw")
    rows = [(3, y), (7, x), (7, y), (None, z), (None, v), (None, w), (None, w), (8, v)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, sf).collect()]
    assert sorted(kept, key=repr) == sorted([(3, y), (7, x), (8, v), (None, z), (None, w)], key=repr)


def test_against_brute_force(spark, tmp_path):
    import random
    import zlib

    import numpy as np
    import public_tokenizers as public
    import test_lines
    import test_simhash
    import test_suffix
    from tokenizers import Tokenizer

    rng = random.Random(21)
    word = lambda: "".join(rng.choice(["ba", "do", "ki", "lu", "mé", "sen", "tor"]) for _ in range(rng.randint(1, 4)))
    line = lambda: " ".join(word() for _ in range(rng.randint(4, 14)))
    passage = " ".join(word() for _ in range(60))
    docs = [(0, None), (1, ""), (2, " \n ")]
    for i in range(3, 150):
        lines_ = [line() for _ in range(rng.randint(1, 8))]
        kind = rng.random()
        if kind < 0.25:  # toxic
            lines_[0] += " grumph blarg snerk"
        elif kind < 0.35 and i > 10:  # a copy, with a word changed
            lines_ = (docs[rng.randrange(5, i - 3)][1] or "x").replace(" ", "  ", 1).split("\n")
        elif kind < 0.5:  # a passage that others have, within other words
            lines_.insert(0, f"{word()} {passage} {word()}")
        docs.append((i, "\n".join(lines_)))
    toxic = {i for i, t in docs if "grumph" in (t or "")}
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], kind).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i, _ in docs], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    left = [(i, t) for i, t in docs if i not in toxic]
    cut = test_lines.brute(left, 20)
    fps = {i: test_simhash.brute_fingerprint(cut[i]) for i, _ in left}
    component = test_simhash.brute_components(list(fps), list(fps.values()))
    left = [(i, cut[i]) for i, _ in left if component[i] == i]
    gone = test_suffix.removed([t for _, t in left], 200)
    own = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    want = []
    for (i, t), g in zip(left, gone):
        kept = bytes(b for b, x in zip(t.encode(), g) if not x).decode(errors="ignore")
        ids = np.array(own.encode(kept, add_special_tokens=False).ids + [2], "<u4")
        first, s = len(ids) % 1024 or 1024, 0
        for piece, e in enumerate(range(first, len(ids) + 1, 1024)):
            want.append((i, piece, s, e - s, zlib.crc32(ids[s:e].tobytes())))
            s = e
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert any(any(g) for g in gone) and len(left) < len(docs) - len(toxic) and any(cut[i] != (t or "") for i, t in docs if i in cut)
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
