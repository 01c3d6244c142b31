"""Stages that write their rows with what they counted on the way: statistics, id maps and meta beside the output.

Counts are observed in the job that writes, so nothing is scanned a second time for them.  A stage's statistics
are one JSON object in a folder named like the output with `.stats` after it, written when the output is there.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from textloom.functions import vectors as V
from textloom.operators import dedup, mining, vectorindex
from textloom.operators.rows import prune, timed
from textloom.sources.jsonl import write_jsonl


def write_json(spark: SparkSession, path: str, value: dict[str, Any]) -> None:
    """One JSON object as the only line of a folder."""
    spark.createDataFrame([(json.dumps(value, ensure_ascii=False, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict[str, Any]:
    return json.loads(spark.read.text(path).first()[0])


class Stage:
    """Gathers what a stage counts and how long it takes, and writes both.

    with Stage(spark, "clean", f"{root}/documents", inputs={"pages": pages_path}) as stage:
        pages = stage.counted(pages, "pages", total=F.count("*"), errors=F.count_if(F.col("html").isNull()))
        rows = stage.write(crawl.clean(pages), kept=F.count("*"))
    stage.stats  # {"stage": "clean", "counts": {"total": .., "errors": .., "kept": ..}, "timing": {..}, ..}

    Counts are aggregates of the rows at the place where they are asked for, without nulls in place of none.  A
    stage that fails writes no statistics."""

    def __init__(self, spark: SparkSession, name: str, path: str, inputs: dict[str, str] | None = None, meta: dict[str, Any] | None = None):
        self.spark, self.name, self.path = spark, name, path.rstrip("/")
        self.inputs, self.meta = inputs or {}, meta or {}
        self.timing: dict[str, float] = {}
        self.counts: dict[str, Any] = {}
        self.seen: list[Observation] = []
        self.stats: dict[str, Any] = {}

    def __enter__(self) -> Stage:
        self.began = time.monotonic()
        return self

    def counted(self, rows: DataFrame, label: str, **counts: Column) -> DataFrame:
        """rows as they are; the counts are taken where these rows pass in the job that writes."""
        taken = Observation(f"{self.name}.{label}.{len(self.seen)}")
        self.seen.append(taken)
        return rows.observe(taken, *(c.alias(n) for n, c in counts.items()))

    def timed(self, label: str):
        return timed(self.timing, label)

    def write(self, rows: DataFrame, mode: str = "overwrite", **counts: Column) -> DataFrame:
        """Writes rows as Parquet at the stage's path, gathers all counts, and reads the rows back."""
        if counts:
            rows = self.counted(rows, "out", **counts)
        with self.timed("write"):
            rows.write.mode(mode).parquet(self.path)
        for taken in self.seen:
            self.counts.update(taken.get)
        self.seen = []
        return self.spark.read.schema(rows.schema).parquet(self.path)

    def __exit__(self, kind, value, trace) -> None:
        if kind is None:
            self.timing["total"] = time.monotonic() - self.began
            self.stats = {"stage": self.name, "counts": self.counts, "timing": {k: round(v, 4) for k, v in self.timing.items()}, "inputs": self.inputs, "outputs": {"rows": self.path, "stats": f"{self.path}.stats"}, "meta": self.meta}
            write_json(self.spark, f"{self.path}.stats", self.stats)


def embed_chunks(chunks: DataFrame, path: str, encode: Callable[[Column], Column] = V.hashed_embedding, threshold: float | None = None, topk: int = 20, meta: dict[str, Any] | None = None, **index: Any) -> dict[str, Any]:
    """Vectors of chunks (chunk_id, chunk_text, ord) below a path, and what stands beside them; the meta object is returned.

    vectors  id, chunk_id, v: ids from 0 in order of ord, without gaps
    id_map   JSON lines of id and chunk_id
    index    the stored vector index over the ids
    chunks   the rows of chunks that have a vector
    meta     counts, dimensions, dedup settings, timing

    threshold: near copies go first (greedy in the order of ord, found by an index of all), and what is left is
    numbered anew.  Blank texts are encoded as any other; chunks with a null ord come first."""
    spark = chunks.sparkSession
    with Stage(spark, "embed_chunks", f"{path}/encoded", meta=meta) as stage:
        made = stage.counted(chunks.select("chunk_id", "chunk_text", "ord"), "in", total_chunks_in=F.count("*"))
        made = made.select("chunk_id", "ord", encode("chunk_text").alias("v")).select("chunk_id", "ord", V.l2_normalize("v").alias("v"))
        encoded = stage.write(made, dim=F.max(F.size("v")))
        kept = mining.numbered(encoded, ["ord", "chunk_id"], "id").select("id", "chunk_id", "v")
        if threshold is not None:
            with stage.timed("dedup"):
                removed = dedup.near_dedup(kept.select("id", F.col("v").alias("embedding")), threshold, topk, path=f"{path}/dedup-index").filter("removed").select("id")
                kept = mining.numbered(prune(kept, removed, "id").withColumnRenamed("id", "old"), ["old"], "id").select("id", "chunk_id", "v")
        with stage.timed("vectors"):
            taken = Observation("embed_chunks.vectors")
            kept.observe(taken, F.count("*").alias("total_vectors_out")).write.mode("overwrite").parquet(f"{path}/vectors")
            vectors = spark.read.parquet(f"{path}/vectors")
            write_jsonl(vectors.select("id", "chunk_id"), f"{path}/id_map")
            chunks.join(vectors.select("chunk_id"), "chunk_id", "left_semi").write.mode("overwrite").parquet(f"{path}/chunks")
        with stage.timed("index"):
            built = vectorindex.build_vector_index(vectors.select(F.col("id").alias("doc_key"), "v"), f"{path}/index", **index)
        stage.counts |= taken.get | {"num_removed": stage.counts["total_chunks_in"] - taken.get["total_vectors_out"], "indexed": built.n_rows, "lists": len(built.centroids), "probes": built.probes}
        stage.meta |= {"semantic_dedup": {"enabled": threshold is not None, "threshold": threshold, "topk": topk if threshold is not None else None}, "created_at_unix": int(time.time())}
    write_json(spark, f"{path}/meta", stage.stats)
    return stage.stats
