import json

import pytest
from pyspark.sql import functions as F

from textloom.functions import vectors as V
from textloom.operators import crawl, stages, vectorindex


def jobs(spark, group):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_counts_come_from_the_job_that_writes(spark, tmp_path):
    text = "word " * 60
    pages = spark.createDataFrame([("http://a/", f"<p>{text}</p>"), ("http://b/", "<p>x</p>"), ("http://c/", None)], "url string, html string")
    spark.sparkContext.setJobGroup("stage-counts", "")
    with stages.Stage(spark, "clean", f"file://{tmp_path}/docs", inputs={"pages": "memory"}, meta={"fingerprint": "f"}) as stage:
        seen = stage.counted(pages, "pages", total=F.count("*"), errors=F.count_if(F.col("html").isNull()))
        rows = stage.write(crawl.clean(seen), kept=F.count("*"), chars=F.sum(F.length("text")))
    assert jobs(spark, "stage-counts") == 2  # the rows and the statistics
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert stage.counts == {"total": 3, "errors": 1, "kept": 1, "chars": len(text) - 1} and rows.count() == 1
    told = stages.read_json(spark, f"file://{tmp_path}/docs.stats")
    assert told == stage.stats and told["stage"] == "clean" and told["inputs"] == {"pages": "memory"} and told["meta"] == {"fingerprint": "f"}
    assert set(told["timing"]) == {"write", "total"} and told["timing"]["total"] >= told["timing"]["write"] > 0


def test_no_rows_and_a_failing_stage(spark, tmp_path):
    with stages.Stage(spark, "s", f"file://{tmp_path}/o") as stage:
        stage.write(spark.range(0), n=F.count("*"))
    assert stage.counts == {"n": 0}
    with pytest.raises(Exception, match="no luck"), stages.Stage(spark, "s", f"file://{tmp_path}/bad") as stage:
        stage.write(spark.range(3).select(F.raise_error(F.lit("no luck")).alias("x")))
    assert not (tmp_path / "bad.stats").exists() and stage.stats == {}


def test_embed_chunks(spark, tmp_path):
    texts = [f"alpha{i} beta{i * 7} gamma{i % 3} delta epsilon{i}" for i in range(40)]
    rows = [(f"c{i}", t, i * 10) for i, t in enumerate(texts)] + [("copy1", texts[3], 5000), ("copy2", texts[3].upper(), 6000), ("blank", " ", 7000)]
    chunks = spark.createDataFrame(rows, "chunk_id string, chunk_text string, ord long").repartition(5)
    path = f"file://{tmp_path}/v"
    stats = stages.embed_chunks(chunks, path, threshold=0.99, topk=5, meta={"fingerprint": "z"}, k=3)
    c = stats["counts"]
    assert (c["total_chunks_in"], c["total_vectors_out"], c["num_removed"], c["dim"], c["indexed"]) == (43, 41, 2, 64, 41)
    assert stats["meta"]["semantic_dedup"] == {"enabled": True, "threshold": 0.99, "topk": 5} and stats["meta"]["fingerprint"] == "z"
    assert stages.read_json(spark, f"{path}/meta") == stats
    ids = {r.id: r.chunk_id for r in spark.read.json(f"{path}/id_map").collect()}
    assert sorted(ids) == list(range(41)) and [ids[i] for i in range(41)] == [f"c{i}" for i in range(40)] + ["blank"]
    assert {r.chunk_id for r in spark.read.parquet(f"{path}/chunks").collect()} == set(ids.values())
    index = vectorindex.load_vector_index(spark, f"{path}/index")
    q = chunks.filter("chunk_id = 'copy2'").select(F.col("chunk_id").alias("query_id"), V.hashed_embedding("chunk_text").alias("v"))
    assert ids[vectorindex.search(index, q, 1, probes=len(index.centroids)).first().doc_key] == "c3"
    plain = stages.embed_chunks(chunks, f"file://{tmp_path}/w")
    assert plain["counts"]["num_removed"] == 0 and plain["meta"]["semantic_dedup"]["enabled"] is False
    assert json.dumps(plain)
