"""Exact and greedy semantic dedup."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.functions import vectors as V
from textloom.operators import vectorindex
from textloom.operators.lineage import cut, stored
from textloom.operators.retrieve import alike, nearest

CLOSE = 0.8  # from this threshold on few pairs reach it, and only these are kept


def keep_first(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key, null keys too (nulls are equal); nulls of the order come first, and of rows with one
    order the least in all columns stays (columns that can't be ordered decide nothing).  Map-side: the first
    row is aggregated, so no key's rows meet."""
    rest = [c for c in rows.columns if c not in key]
    sortable = [c for c in rest if "map<" not in rows.schema[c].dataType.simpleString() and "variant" not in rows.schema[c].dataType.simpleString()]
    first = F.min_by(F.struct(*rest), F.struct(*order, *(c for c in sortable if c not in order))) if rest else F.lit(None)
    kept = rows.groupBy(*key).agg(first.alias("__first"))
    return kept.select(*(F.col(c) if c in key else F.col(f"__first.{c}").alias(c) for c in rows.columns))


def require_key(rows: DataFrame, key: str) -> DataFrame:
    """Rows as they are; the query fails where the key is missing."""
    return rows.filter(F.assert_true(F.coalesce(F.col(key) != "", F.lit(False)), F.lit(f"a row has no {key}")).isNull())


def greedy(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes (id) with removed: what a scan in order of ids keeps, where each kept node removes the later
    ones its edges (src < dst) reach.  A node is decided once all before it are, or one that is kept reaches it;
    each round decides all such nodes at once, so rounds follow the longest chain, not the rows."""
    edges = cut(edges.select("src", "dst").filter("src < dst").distinct())
    state = cut(nodes.select("id").distinct().join(edges.select(F.col("dst").alias("id")).distinct().withColumn("hit", F.lit(True)), "id", "left").select("id", F.when(F.col("hit"), None).otherwise(F.lit(False)).alias("removed")))
    while True:
        open_ = state.filter("removed is null").select(F.col("id").alias("dst"))
        if open_.isEmpty():
            return state
        votes = edges.join(open_, "dst").join(state.select(F.col("id").alias("src"), "removed"), "src").groupBy("dst").agg(F.max(F.expr("removed is not null and not removed")).alias("hit"), F.min(F.expr("removed is not null and removed")).alias("free"))
        decided = votes.select(F.col("dst").alias("id"), F.when(F.col("hit"), True).when(F.col("free"), False).alias("now"))
        state = cut(state.join(decided, "id", "left").select("id", F.coalesce("removed", "now").alias("removed")))


def near_dedup(rows: DataFrame, threshold: float = 0.95, k: int = 20, key: str = "id", vector: str = "embedding", path: str | None = None) -> DataFrame:
    """(id, removed) of rows (key: long, vector): greedy removal of later rows among the k nearest (itself counted) with cosine >= threshold.
    The nearest rows are those of a whole scan, or with a path those that a vector index written there finds.
    A row without a usable vector is kept."""
    if k < 2:
        raise ValueError("k is at least 2")
    unit = rows.select(F.col(key).alias("id"), V.l2_normalize(vector).alias("v"))
    queries, corpus = unit.select(F.col("id").alias("query_id"), "v"), unit.select(F.col("id").alias("doc_key"), "v")
    if path is None and threshold >= CLOSE:
        edges = _close(unit, threshold, k)
    else:
        if path is None:
            near = nearest(queries, corpus, k - 1, skip_self=True)
        else:
            near = vectorindex.search(vectorindex.build_vector_index(corpus, path, k=k), queries, k - 1, skip_self=True)
        edges = near.filter((F.col("score") >= threshold) & (F.col("doc_key") > F.col("query_id"))).select(F.col("query_id").alias("src"), F.col("doc_key").alias("dst"))
    return greedy(unit, edges)


def _close(unit: DataFrame, threshold: float, k: int) -> DataFrame:
    """(src, dst): of each row (id, v: a unit vector) the later ones among its k - 1 nearest others with a product of threshold or more.
    Rows of one vector have one list of nearest rows, in which a vector stands for its k first rows; so only distinct vectors
    are compared, and only pairs that reach the threshold leave a task."""
    good = unit.filter(V.usable("v"))
    first = stored(good.groupBy("v").agg(F.min("id").alias("doc_key")), "distinct-vectors")
    named = stored(good.join(first, "v").select("id", "doc_key"), "vectors-of-rows")
    w = Window.partitionBy("doc_key").orderBy("id")
    heads = named.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= k).groupBy("doc_key").agg(F.collect_list("id").alias("ids"))  # k at most
    near = alike(first, k, threshold).join(heads, "doc_key").select("query_id", "score", F.explode("ids").alias("id"))
    w = Window.partitionBy("query_id").orderBy(F.round("score", 6).desc(), "id")
    lists = near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    lists = lists.groupBy(F.col("query_id").alias("doc_key")).agg(F.array_sort(F.collect_list(F.struct("rank", F.col("id").alias("dst"), "score"))).alias("l"))  # k at most
    others = F.slice(F.filter("l", lambda x: x["dst"] != F.col("id")), 1, k - 1)
    later = F.filter(others, lambda x: (x["dst"] > F.col("id")) & (x["score"] >= threshold))
    return named.join(lists, "doc_key").select(F.col("id").alias("src"), F.explode(F.transform(later, lambda x: x["dst"])).alias("dst"))


def within_groups(rows: DataFrame, threshold: float, strict: bool = True) -> DataFrame:
    """rows (grp, ord, v: unit vectors) with kept: per group, a scan in order of ord that drops what is closer
    than threshold to any kept row.  Groups are candidate lists of one query, bounded by its top-k."""

    def scan(items):
        for batch in items:
            out = []
            for group in batch.column("items").to_pylist():
                held: list[np.ndarray] = []
                for r in sorted(group, key=lambda r: r["ord"]):
                    v = np.array(r["v"])
                    score = max((float(v @ h) for h in held), default=-math.inf)
                    ok = not (score > threshold if strict else score >= threshold)
                    if ok:
                        held.append(v)
                    out.append((r["ord"], ok))
            n = [len(g) for g in batch.column("items").to_pylist()]
            grp = batch.column("grp").take(pa.array(np.repeat(np.arange(len(n)), n)))
            yield pa.RecordBatch.from_arrays([grp, pa.array([o for o, _ in out], pa.int64()), pa.array([k for _, k in out])], ["grp", "ord", "kept"])

    kind = rows.schema["grp"].dataType.simpleString()
    lists = rows.groupBy("grp").agg(F.collect_list(F.struct(F.col("ord").cast("long").alias("ord"), "v")).alias("items"))
    return lists.mapInArrow(scan, f"grp {kind}, ord long, kept boolean")


def dedup_stats(rows: DataFrame, key: str) -> DataFrame:
    """total, kept and removed rows of a keep-first by key."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("kept")).select("total", "kept", (F.col("total") - F.col("kept")).alias("removed"))


def query_dedup(queries: DataFrame, min_chars: int = 20, threshold: float = 0.95, k: int = 50) -> DataFrame:
    """queries (id, text) with removed: semantic dedup that leaves short texts alone."""
    long = queries.filter(F.length(F.trim("text")) >= min_chars)
    marked = near_dedup(long.withColumn("embedding", V.hashed_embedding("text")), threshold, k)
    return queries.join(marked, "id", "left").select("id", "text", F.coalesce("removed", F.lit(False)).alias("removed"))


def merge_exact(a: DataFrame, b: DataFrame, key: str = "query_id") -> DataFrame:
    """All rows of a, then those of b whose key is not in a; repeats within one side and null keys stay."""
    return a.unionByName(b.join(a.select(key).distinct(), key, "left_anti"))


def first_by(rows: DataFrame, key: str, order: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(order)
    return rows.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")
