"""Connected components by alternating large-star and small-star rounds over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.shared import cut, drop, parts


def hub_join(rows: DataFrame, right: DataFrame, key: str, by: str, how: str = "inner") -> DataFrame:
    """rows.join(right, key, how) for a right side of few rows a key, where a key may hold very many of the rows.

    A key's rows are dealt to as many places as there are partitions, by a hash of the column `by`; the
    right side goes only to the places that its key has."""
    places = 4 * parts(rows.sparkSession)
    rows = rows.withColumn("__place", F.pmod(F.xxhash64(by), F.lit(places)))
    at = rows.select(key, "__place").distinct().join(right, key, how)
    return rows.join(at, [key, "__place"]).drop("__place")


def _done(links: DataFrame) -> bool:
    """Whether the links (a, b) are stars: each a has one b, which is nobody's a."""
    many = links.groupBy("a").agg(F.min("b").alias("b"), F.max("b").alias("c")).filter("b <> c")
    roots = links.select(F.col("b").alias("a")).distinct().join(links.select("a").distinct(), "a")
    return many.isEmpty() and roots.isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b), long; component is the least node reachable.

    Links may repeat, point either way and join a node to itself; none gives no rows.  Minima are
    aggregated before the shuffle and a node's links are dealt to many places where they meet its minimum,
    so a node with very many links is no group in one task.  A round's table goes when the next is written.
    """
    a, b = F.col("a"), F.col("b")
    edges = cut(edges.filter("a <> b").select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "links")
    while not _done(edges):
        # large star: all larger neighbours of a node go to its least neighbour (or itself)
        least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "b")
        large = hub_join(edges, least, "b", "a", "left").select("a", F.coalesce("m", "b").alias("b")).distinct()
        # small star: smaller neighbours and the node itself go to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        ends = F.explode(F.array(F.struct(b.alias("a"), F.col("m").alias("b")), F.struct(a.alias("a"), F.col("m").alias("b"))))
        small = hub_join(large, least, "a", "b").select(ends.alias("e")).select("e.a", "e.b").filter("a <> b").distinct()
        before, edges = edges, cut(small, "links")
        drop(before)
    return edges.select(a.alias("node"), b.alias("component")).unionByName(edges.select(b.alias("node"), b.alias("component")).distinct())
