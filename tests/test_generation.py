import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from textloom.operators import mining
from textloom.streaming import generation

KIND = "chunk_id string, chunk_text string, ord long"


@pytest.fixture(scope="module")
def chunks(spark):
    said = ["the house of many rooms", "nothing here that counts", "rivers and mountains", "a plain sentence number"]
    rows = [(f"c{i}", f"{said[i % 4]} {i // 3}. {'Short.' if i % 5 else said[(i + 1) % 4] + '!'} {said[2]} {i % 7}.", 1000 - i) for i in range(120)]
    return spark.createDataFrame(rows + [("empty", "", 5), ("short", "No.", 6)], KIND)


def told(df):
    return sorted((r.query_id, r.query_text_norm, tuple(r.source_chunk_ids), r.domain, r.batch) for r in df.collect())


def place(tmp_path, *names):
    return [f"file://{tmp_path}/{n}" for n in names]


@pytest.mark.parametrize("target", [1, 12, 10_000])
def test_a_stream_gives_the_rows_of_one_batch_run(spark, tmp_path, chunks, target):
    parts, out, state = place(tmp_path, "parts", "out", "state")
    assert generation.write_parts(chunks, parts, cap=110, size=9) == 13
    got = told(generation.run(spark, parts, out, state, target, size=7))
    want = told(mining.query_run(chunks, None, target, 110, size=7))
    assert got == want and got
    assert told(generation.run(spark, parts, out, state, target, size=7)) == want  # nothing is left to do


def test_stopped_and_restarted_in_any_order_of_files(spark, tmp_path, chunks):
    every, parts, out, state = place(tmp_path, "every", "parts", "out", "state")
    generation.write_parts(chunks, every, cap=200, size=10)
    want = told(mining.query_run(chunks, None, 25, 200, size=6))
    os.makedirs(f"{tmp_path}/parts")
    files = sorted(glob.glob(f"{tmp_path}/every/*.parquet"))
    seen = []
    for some in (files[::3], files[1::3], files[2::3]):  # parts come before their turn
        for f in some:
            shutil.copy(f, f"{tmp_path}/parts/")
        seen.append(told(generation.run(spark, parts, out, state, 25, size=6, files=2)))
    assert seen[-1] == want and set(seen[0]) <= set(seen[1]) <= set(want)


def test_a_run_that_fails_goes_on(spark, tmp_path, chunks):
    parts, out, state = place(tmp_path, "parts", "out", "state")
    generation.write_parts(chunks, parts, size=20)
    fails = lambda text, n: F.when(F.contains(text, F.lit("rooms 20.")), F.raise_error(F.lit("no answer")).cast("array<string>")).otherwise(mining.sentences(text, n))
    with pytest.raises(Exception, match="no answer"):
        generation.run(spark, parts, out, state, 10_000, files=1, model=fails)
    assert told(generation.run(spark, parts, out, state, 10_000, files=1)) == told(mining.query_run(chunks, None, 10_000))


def test_previous_queries_count_and_are_not_made_again(spark, tmp_path, chunks):
    parts, out, state = place(tmp_path, "parts", "out", "state")
    first = mining.query_run(chunks, None, 20, 200, size=5).filter("batch < 3")
    generation.write_parts(chunks, parts, cap=200, size=30)
    got = told(generation.run(spark, parts, out, state, 20, previous=first, size=5))
    assert got == told(mining.query_run(chunks, first, 20, 200, size=5)) and got


def test_no_chunks(spark, tmp_path, chunks):
    parts, out, state = place(tmp_path, "parts", "out", "state")
    assert generation.write_parts(chunks.limit(0), parts) == 0
    assert generation.run(spark, parts, out, state, 5).count() == 0
