"""Queries mined from chunks, and packs of a query with its positives and negatives.

Model calls are Column functions given by the caller; the defaults are deterministic and offline.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.functions import text as T
from textloom.functions import vectors as V
from textloom.operators import dedup, retrieve
from textloom.operators.lineage import cut

KEYWORDS = ["the", "and", "with"]
HEAD = "Read the text below and write {n} {style} search queries that it answers, one on each line."


def by_hash(key: str | Column, seed: int) -> Column:
    """A shuffle's order that every engine agrees on: SHA-256 of seed:key."""
    return T.sha256(F.concat(F.lit(f"{seed}:"), T.col(key).cast("string")))


def sample(chunks: DataFrame, cap: int, seed: int = 42, key: str = "chunk_id") -> DataFrame:
    """At most cap rows, uniformly, the same for the same seed."""
    return chunks.orderBy(by_hash(key, seed), key).limit(cap)


def sample_per_document(chunks: DataFrame, cap: int, seed: int = 42, key: str = "chunk_id", doc: str = "doc_id") -> DataFrame:
    w = Window.partitionBy(doc).orderBy(by_hash(key, seed), key)
    return chunks.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= cap).drop("__n")


def sentences(text, n: int) -> Column:
    """The default generator: the first n sentences."""
    return F.slice(F.filter(F.transform(F.split(T.safe(text), r"[.!?\n]+"), T.strip), lambda s: s != ""), 1, n)


def candidates(chunks: DataFrame, n: int = 2, min_chars: int = 12, max_chars: int = 160, max_chunk_chars: int = 2100, model: Callable[[Column, int], Column] = sentences, keep: tuple[str, ...] = ()) -> DataFrame:
    """(query_id, query_text_norm, chunk_id, chunk_ord, place) of what a model makes of chunks (chunk_id, chunk_text, ord):
    cut and normalised.  Too short ones have a null id, as has a row for a chunk without any."""
    raw = chunks.select("chunk_id", F.col("ord").alias("chunk_ord"), *keep, F.posexplode_outer(model(F.left("chunk_text", F.lit(max_chunk_chars)), n)).alias("place", "q"))
    norm = F.when(T.query_text("q", min_chars, max_chars).isNotNull(), T.normalize(T.query_text("q", min_chars, max_chars)))
    rows = raw.withColumn("query_text_norm", F.nullif(norm, F.lit("")))
    return rows.select(F.when(F.col("query_text_norm").isNotNull(), T.short_id("query_text_norm")).alias("query_id"), "query_text_norm", "chunk_id", "chunk_ord", "place", *keep)


def generated(chunks: DataFrame, **options) -> DataFrame:
    """(query_id, query_text_norm, source_chunk_ids, chunk_ord, place) of chunks: the candidates, one row a query_id (the first)."""
    rows = candidates(chunks, **options).filter("query_id is not null")
    first = rows.groupBy("query_id", "query_text_norm").agg(F.min(F.struct("chunk_ord", "place", "chunk_id")).alias("r"))
    return first.select("query_id", "query_text_norm", F.array("r.chunk_id").alias("source_chunk_ids"), "r.chunk_ord", "r.place")


def keyword_domain(text: Column, keywords: list[str] = KEYWORDS) -> Column:
    """The default classifier: in-domain if a token is among the keywords."""
    return F.arrays_overlap(T.tokenize(text), F.array(*(F.lit(k) for k in keywords)))


def batched(queries: DataFrame, size: int = 15, order: list[str] | None = None) -> DataFrame:
    """queries with their place n from 0 and micro-batch."""
    return numbered(queries, order or ["chunk_ord", "place", "query_id"]).withColumn("batch", F.floor(F.col("n") / size))


def numbered(rows: DataFrame, order: list[str], out: str = "n") -> DataFrame:
    """rows with their place from 0 in the given order (nulls first; a number first, many values of it): a running
    count of a few ranges of the first column for each partition, each of about as many rows, and a window within
    each.  No task ranks all rows."""
    ranges = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx(order[0], [i / ranges for i in range(1, ranges)], 100 * ranges)).first()[0] or []
    place = F.size(F.filter(F.array(*map(F.lit, sorted(set(cuts)))), lambda c: c < F.col(order[0]))) if cuts else F.lit(0)
    marked = rows.withColumn("__b", F.when(F.col(order[0]).isNull(), -1).otherwise(place))
    sizes = marked.groupBy("__b").agg(F.count("*").alias("__size"))
    starts = sizes.withColumn("__start", F.sum("__size").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)))  # a row for each range
    joined = marked.withColumn("__i", F.row_number().over(Window.partitionBy("__b").orderBy(*order)) - 1).join(starts.select("__b", F.coalesce("__start", F.lit(0)).alias("__start")), "__b")
    return joined.withColumn(out, (F.col("__start") + F.col("__i")).cast("long")).drop("__b", "__i", "__start")


def sum_before(sums: DataFrame, key: str, value: str, span: int = 4096) -> DataFrame:
    """sums (key from 0, value) with before, the sum over smaller keys; spans of keys are summed first, so a window over all has few rows."""
    marked = sums.withColumn("__s", F.floor(F.col(key) / span))
    below = Window.orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    coarse = marked.groupBy("__s").agg(F.sum(value).alias("__v")).withColumn("__base", F.coalesce(F.sum("__v").over(below), F.lit(0))).select("__s", "__base")
    within = Window.partitionBy("__s").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return marked.withColumn("__w", F.coalesce(F.sum(value).over(within), F.lit(0))).join(coarse, "__s").withColumn("before", F.col("__base") + F.col("__w")).drop("__s", "__w", "__base")


def until_target(batches: DataFrame, target: int, done: int = 0) -> DataFrame:
    """Rows (batch, in_domain, ..) of the batches that run before the count of in-domain queries reaches the target; whole batches only."""
    sums = batches.groupBy("batch").agg(F.sum(F.col("in_domain").cast("int")).alias("hits"))
    kept = sum_before(sums, "batch", "hits").filter(F.col("before") + done < target)
    return batches.join(kept.select("batch"), "batch", "left_semi")


def query_run(chunks: DataFrame, previous: DataFrame | None = None, target: int = 2000, cap: int = 6500, seed: int = 42, size: int = 15, classify: Callable[[Column], Column] = keyword_domain, **options) -> DataFrame:
    """Incremental query generation: sample, generate, skip ids already there, classify in batches, stop at the target."""
    new = cut(generated(sample(chunks, cap, seed), **options))  # a few rows for each of cap chunks, ranked and counted below
    done = 0
    if previous is not None:
        new = new.join(previous.select("query_id").distinct(), "query_id", "left_anti")
        done = previous.filter("domain = 'in'").count()
    marked = batched(new, size).withColumn("in_domain", classify(F.col("query_text_norm")))
    return until_target(marked, target, done).select("query_id", "query_text_norm", "source_chunk_ids", F.when(F.col("in_domain"), "in").otherwise("out").alias("domain"), "batch")


def source_chunks(queries: DataFrame, chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(queries with their first source's text, queries whose source is missing)."""
    q = queries.withColumn("chunk_id", F.get("source_chunk_ids", F.lit(0)))
    return q.join(chunks.select("chunk_id", "chunk_text"), "chunk_id"), q.join(chunks.select("chunk_id"), "chunk_id", "left_anti")


def coverage(query: Column, text: Column, least: float = 0.3) -> Column:
    """The default answerability: enough of the query's tokens occur."""
    return retrieve.overlap_score(query, text) >= F.lit(least)


def packs(queries: DataFrame, chunks: DataFrame, found: DataFrame, threshold: float = 0.9, encode: Callable[[Column], Column] = V.hashed_embedding, answerable: Callable[[Column, Column], Column] = coverage, keep: int = 15) -> DataFrame:
    """(query_id, query_text, source_id, positives, negatives): per query the source chunk and, of what retrieval
    found (query_id, doc_key, rank), candidates without the source, repeats and blanks, and not closer than
    threshold to the source or an earlier one; those that answer the query are positives with the source."""
    q = queries.select("query_id", F.col("query_text_norm").alias("query_text"), F.get("source_chunk_ids", F.lit(0)).alias("source_id"))
    texts = dedup.keep_first(chunks.select("chunk_id", "chunk_text", "ord"), ["chunk_id"], ["ord"]).select("chunk_id", "chunk_text")
    candidates = found.filter(F.col("rank") <= keep).select("query_id", F.col("doc_key").alias("chunk_id"), F.col("rank").alias("ord"))
    rows = q.select("query_id", F.col("source_id").alias("chunk_id"), F.lit(0).alias("ord")).unionByName(candidates.join(q.select("query_id", F.col("source_id").alias("s")), "query_id").filter("chunk_id <> s").drop("s"))
    rows = rows.join(texts, "chunk_id").filter(T.strip("chunk_text") != "")
    vectors = rows.select("chunk_id", "chunk_text").distinct().select("chunk_id", encode("chunk_text").alias("v"))
    kept = dedup.within_groups(rows.join(vectors, "chunk_id").select(F.col("query_id").alias("grp"), "ord", "v"), threshold)
    rows = rows.join(kept.filter("kept").select(F.col("grp").alias("query_id"), F.col("ord").cast("int").alias("ord")), ["query_id", "ord"]).join(q.select("query_id", "query_text", "source_id"), "query_id")
    rows = rows.withColumn("positive", (F.col("ord") == 0) | answerable(F.col("query_text"), F.col("chunk_text")))
    lists = lambda on: F.transform(F.array_sort(F.collect_list(F.when(on, F.struct("ord", "chunk_id")))), lambda x: x["chunk_id"])
    return rows.groupBy("query_id", "query_text", "source_id").agg(lists(F.col("positive")).alias("positives"), lists(~F.col("positive")).alias("negatives"))


def grounded_sources(rows: DataFrame, chunks: DataFrame, pick: str = "first", most: int = 3, separator: str = "\n\n---\n\n") -> DataFrame:
    """(query_id, used_ids, chunk_text): a query's first source that exists, or its first `most` joined; queries without any go."""
    each = rows.select("query_id", F.posexplode("source_chunk_ids").alias("pos", "chunk_id")).join(chunks.select("chunk_id", "chunk_text"), "chunk_id")
    listed = each.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("pos", "chunk_id", "chunk_text"))), 1, most if pick == "concat" else 1).alias("l"))
    return listed.select("query_id", F.transform("l", lambda x: x["chunk_id"]).alias("used_ids"), F.array_join(F.transform("l", lambda x: x["chunk_text"]), separator).alias("chunk_text"))


def generation_prompt(text, style: str = "information-seeking", n: int = 3, hints: str = "") -> Column:
    """What a query generator is asked."""
    middle = f"Let them differ in these ways:\n{hints.strip()}\n" if hints else ""
    return F.concat(F.lit(f"{HEAD.format(n=n, style=style)}\n{middle}\nText:\n"), T.safe(text))
