"""A corpus pipeline of five stages, each one operator of textloom.llm.

Each stage takes (spark, docs, sf_dir); run() writes its rows as Parquet and rereads them as the next
stage's docs.  All but the last return the columns of documents; n_chars follows the text.

toxicity     documents predicted toxic go (labels of sf_dir; those held out are never learned)
line dedup   aligned blocks of lines go from the later document; a document may become empty
simhash      one row of each class stays, the one with the least doc_id (null last), then text hash
suffix array bytes of repeated 200-byte strings go; code points they cut through go whole
packing      token pieces of all documents in sequences of at most 1024
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import lines, packing, simhash, suffix, toxicity
from textloom.llm.shared import cut, text_key


def _with_text(docs: DataFrame, columns: list[str]) -> DataFrame:
    """row (the old columns, text and n_chars may lack) and new_text -> the columns with the text and its length replaced."""
    new = {"text": F.col("new_text"), "n_chars": F.length("new_text").cast("long")}
    return docs.select(*((new[c] if c in new else F.col(f"row.{c}")).alias(c) for c in columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, sf_dir)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(lines.dedup_lines(docs).select("row", F.col("kept").alias("new_text")), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class stays, whatever repeats its doc_id or has none; rows equal in doc_id and text are one."""
    k1, k2 = text_key(F.col("text"))
    key = [F.isnull("doc_id").alias("__missing"), F.coalesce("doc_id", F.lit(0)).alias("__d"), k1.alias("__k1"), k2.alias("__k2")]
    names = ["__missing", "__d", "__k1", "__k2"]
    found = simhash.representatives(docs)
    keep = found.select(*key[:2], F.col("k1").alias("__k1"), F.col("k2").alias("__k2"))
    return docs.select("*", *key).join(keep, names, "left_semi").dropDuplicates(names).select(*docs.columns)


def dedup_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A code point that a removed run cuts through goes whole, so texts stay valid UTF-8."""
    found = suffix.remove_repeats(docs.select("text"), points=True).select("k1", "k2", F.col("kept").cast("string").alias("new_text"))
    rows = docs.select(F.struct(*(c for c in docs.columns if c not in ("text", "n_chars"))).alias("row"), *text_key(F.col("text")))
    return _with_text(rows.join(found, ["k1", "k2"]).select("row", "new_text"), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("suffix-array dedup", dedup_substrings),
    ("best-fit packing", pack),
]

#: SQL can express neither the nearest examples nor patience diff, nor suffix arrays or packing over whole tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
