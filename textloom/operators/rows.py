"""Rows of uneven shape made regular, pairs as a trainer reads them, and counts of a stage."""

from __future__ import annotations

import time
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from textloom.functions import text as T
from textloom.operators.mining import by_hash

CHUNK = StructType(
    [StructField("chunk_id", StringType()), StructField("doc_id", StringType()), StructField("chunk_index", IntegerType()), StructField("chunk_text", StringType()), StructField("chunk_text_hash", StringType())]
    + [StructField(n, StringType()) for n in ("url", "title", "source", "content_hash", "content_type", "fetched_at", "run_date")]
)
STRUCTURE = "pages array<struct<blocks: array<struct<text: string>>>>"


def coerce_chunks(rows: DataFrame) -> DataFrame:
    """Rows with the fields of CHUNK: missing ones are null, others cast, a missing text empty, a missing hash made of the text's normal form."""
    given = set(rows.columns)
    cast = {f.name: F.col(f.name).try_cast(f.dataType) if f.name in given else F.lit(None).cast(f.dataType) for f in CHUNK.fields}
    cast["chunk_text"] = F.coalesce(cast["chunk_text"], F.lit(""))
    cast["chunk_index"] = F.coalesce(cast["chunk_index"], F.lit(0))
    cast["chunk_text_hash"] = F.coalesce(F.nullif(cast["chunk_text_hash"], F.lit("")), T.text_sha1(cast["chunk_text"]))
    return rows.select(*(c.alias(n) for n, c in cast.items()))


def structure_chars(json) -> Column:
    """Characters in all blocks of a document's structure (JSON of pages and blocks); null where it can't be read."""
    texts = F.flatten(F.transform(F.from_json(json, STRUCTURE)["pages"], lambda p: F.transform(F.coalesce(p["blocks"], F.array()), lambda b: F.length(F.coalesce(b["text"], F.lit(""))))))
    return F.aggregate(texts, F.lit(0), lambda s, n: s + n)


def pair_texts(pairs: DataFrame, chunks: DataFrame) -> DataFrame:
    """(query_text, positive_text, negative_text, type, epoch) of pairs (query_text, positive, negative: chunk ids): titles on a line before the text."""
    side = lambda name: chunks.select(F.col("chunk_id").alias(name), T.with_title("title", "chunk_text", "\n").alias(f"{name}_text"))
    joined = pairs.join(side("positive"), "positive").join(side("negative"), "negative")
    return joined.select("query_text", "positive_text", "negative_text", "type", "epoch")


def shuffled(rows: DataFrame, key: str, seed: int, epoch: int) -> DataFrame:
    """rows with shuffle_key: ordering by it is an epoch's shuffle, the same for the same seed."""
    return rows.withColumn("shuffle_key", by_hash(F.col(key), seed * 1000 + epoch))


def prune(rows: DataFrame, removed: DataFrame, key: str, enabled: bool = True) -> DataFrame:
    """Rows whose key is not among the removed ones; as they are if not enabled."""
    return rows.join(removed.select(key).distinct(), key, "left_anti") if enabled else rows


@contextmanager
def timed(stages: dict[str, float], name: str):
    """Adds a stage's wall-clock seconds to a dict; the caller writes it with its counts."""
    began = time.monotonic()
    try:
        yield
    finally:
        stages[name] = stages.get(name, 0.0) + time.monotonic() - began
