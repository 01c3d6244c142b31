"""What the queries share: tables, and fragments of the SQL that they are held against."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import chunk
from textloom.operators.lineage import base


CHUNK_PLACES, TURNS = 1 << 24, 1 << 32  # more than chunks of the longest text, and than turns: keys made of two numbers never meet


@dataclass(frozen=True)
class Query:
    """A query and the SQL that gives the same rows (None: SQL can't express it)."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the one that spark.checkpoint.dir names, which executors share."""
    return f"{base(spark)}/{name}-{uuid.uuid4().hex}"


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of documents with ord, their order over all."""
    made = chunk.sliding(table(spark, sf_dir, "documents"))
    return made.withColumn("ord", F.col("doc_id") * F.lit(CHUNK_PLACES) + F.col("chunk_index"))


def asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What users said: (ord, text, query_text_norm, query_id)."""
    said = table(spark, sf_dir, "conversations").filter("role = 'user'").select((F.col("conv_id") * F.lit(TURNS) + F.col("turn")).alias("ord"), "text")
    return said.withColumn("query_text_norm", T.normalize("text")).withColumn("query_id", T.short_id("query_text_norm"))


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


# --- SQL fragments ---------------------------------------------------------------------------

WS = r"[ \t\n\r\f\x0B]"


def s_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def s_rstrip(x: str) -> str:
    return f"regexp_replace({x}, '{WS}+$', '', 'g')"


def s_norm(x: str) -> str:
    inner = s_strip(f"coalesce({x}, '')")
    return f"lower(regexp_replace({inner}, '{WS}+', ' ', 'g'))"


def s_tokens(x: str) -> str:
    return f"regexp_extract_all(lower(coalesce({x}, '')), '[a-z0-9]+')"


def s_id(x: str) -> str:
    return f"left(sha256({x}), 24)"


def s_count(x: str, chars: str) -> str:
    return f"(length({x}) - length(translate({x}, '{chars}', '')))"


CHUNKS = f"""
stripped AS (SELECT doc_id, {s_strip("coalesce(text, '')")} AS t FROM documents),
windowed AS (SELECT doc_id, s, {s_strip("substr(t, s + 1, 1200)")} AS c FROM (SELECT doc_id, t, unnest(range(0, length(t), 1000)) AS s FROM stripped)),
chunks AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS INTEGER) AS chunk_index, c AS chunk_text,
    sha256(c) AS chunk_text_hash, left(sha256(c), 24) AS chunk_id FROM windowed WHERE c <> ''),
placed AS (SELECT *, doc_id * {CHUNK_PLACES} + chunk_index AS ord FROM chunks)
"""

ASKED = f"""
said AS (SELECT conv_id * {TURNS} + turn AS ord, text, {s_norm("text")} AS query_text_norm FROM conversations WHERE role = 'user'),
asked AS (SELECT *, {s_id("query_text_norm")} AS query_id FROM said)
"""

UNIT = "list_transform(embedding::DOUBLE[], lambda x: x / greatest(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 1e-12))"
VECTORS = f"units AS (SELECT vec_id, label, {UNIT} AS v FROM embeddings)"

# BM25 over documents for benchmark texts
POSTINGS = f"""
token AS (SELECT doc_id AS doc_key, unnest({s_tokens("text")}) AS term FROM documents),
posting AS (SELECT doc_key, term, count(*) AS tf FROM token GROUP BY ALL),
doclen AS (SELECT doc_key, sum(tf) AS len FROM posting GROUP BY ALL),
total AS (SELECT count(*) AS n, CAST(sum(coalesce(len, 0)) AS DOUBLE) / count(*) AS avgdl FROM (SELECT doc_id AS doc_key FROM documents) LEFT JOIN doclen USING (doc_key)),
rawidf AS (SELECT term, count(*) AS df, ln(any_value(n) - count(*) + CAST(0.5 AS DOUBLE)) - ln(count(*) + CAST(0.5 AS DOUBLE)) AS raw FROM posting, total GROUP BY term),
idf AS (SELECT term, df, CASE WHEN raw < 0 THEN CAST(0.25 AS DOUBLE) * (SELECT avg(raw) FROM rawidf) ELSE raw END AS idf FROM rawidf)
"""
WANTED = f"""
wanted AS (SELECT item_id AS query_id, term, count(*) AS times FROM (SELECT item_id, unnest({s_tokens("text")}) AS term FROM benchmark) GROUP BY ALL)
"""
SCORED = """
scored AS (
  SELECT query_id, doc_key, sum(times * idf * tf * CAST(2.5 AS DOUBLE) / (tf + CAST(1.5 AS DOUBLE) * (CAST(0.25 AS DOUBLE) + CAST(0.75 AS DOUBLE) * len / avgdl))) AS score
  FROM posting JOIN wanted USING (term) JOIN idf USING (term) JOIN doclen USING (doc_key), total GROUP BY ALL)
"""
BM25 = f"""{POSTINGS},{WANTED},{SCORED},
bm25 AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_key) AS INTEGER) AS rank FROM scored) WHERE rank <= 60)
"""


def s_embed(text: str) -> str:
    places = f"list_transform({s_tokens(text)}, lambda t: ('0x' || left(sha256(t), 7))::BIGINT % 64)"
    return f"list_transform(range(64), lambda i: CAST(len(list_filter({places}, lambda p: p = i)) AS DOUBLE))"


DENSE = f"""
docvec AS (SELECT doc_id AS doc_key, c, greatest(sqrt(list_dot_product(c, c)), 1e-12) AS n FROM (SELECT doc_id, {s_embed("text")} AS c FROM documents)),
queryvec AS (SELECT item_id AS query_id, c, greatest(sqrt(list_dot_product(c, c)), 1e-12) AS n FROM (SELECT item_id, {s_embed("text")} AS c FROM benchmark)),
alike AS (SELECT query_id, doc_key, list_dot_product(q.c, d.c) / q.n / d.n AS score FROM queryvec q, docvec d),
dense AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_key) AS INTEGER) AS rank FROM alike) WHERE rank <= 30)
"""
