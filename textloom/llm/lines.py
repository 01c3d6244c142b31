"""Line dedup by pairwise alignment.

A line is told apart by 96 bits of hashes, without white space at its ends.  A pair of documents that
share a line of `least` characters or more (a long line) is aligned by patience diff (equal ends, then
lines unique in both in their longest common order, then the gaps between them), and aligned runs that
hold a long line are deleted from the later document (by doc_id, then text).  Alignment is on the
documents as they came, not on what is left.

Every earlier document that can change the result is a partner.  A run that deletes a line has it whole,
and if it is short also all lines to the nearest long one before or after it: these stretches are its
keys.  Rare keys come first: only holders of a key of a line not yet deleted are aligned, earliest first,
in rounds of twice as many, so that a key of few documents is done in a round or two, while a frequent one
is carried on only for lines that its earliest holders left.  A document with the lines of an earlier one
is aligned with the first of them alone.  A key's documents are ranked and joined in pieces, so a line
that very many documents hold is no group in one task.

Nulls are empty texts.  Rows equal in doc_id and text are one document; other rows of one doc_id are
ordered by a hash of the text.  A null doc_id comes first.  A document may be left with no text.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.llm.graph import hub_join
from textloom.llm.shared import cut, parts, prepare

LEAST = 20
FIRST = -(2**63)


def _unique_common(a: list, b: list, a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """Places of lines unique in both ranges, in the longest order common to both."""

    def once(x, lo, hi):
        at: dict = {}
        for i in range(lo, hi):
            at[x[i]] = -1 if x[i] in at else i
        return at

    left, right = once(a, a0, a1), once(b, b0, b1)
    pairs = [(i, right[h]) for h, i in left.items() if i >= 0 and right.get(h, -1) >= 0]
    ends: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(ends, j)
        back.append(at[k - 1] if k else -1)
        if k == len(ends):
            ends.append(j)
            at.append(n)
        else:
            ends[k], at[k] = j, n
    out, n = [], at[-1] if at else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places of equal lines, ascending in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 < a1 and b0 < b1:
            found = _unique_common(a, b, a0, a1, b0, b1)
            for i, j in found:
                out.append((i, j))
                if a0 < i and b0 < j:
                    todo.append((a0, i, b0, j))
                a0, b0 = i + 1, j + 1
            if found and a0 < a1 and b0 < b1:
                todo.append((a0, a1, b0, b1))
    return sorted(out)


def _delete(batches):
    """For pairs (d, k of the later document; h and g of the first, of the later; which of its lines are long): the later's places to delete."""
    for batch in batches:
        out = []
        for h1, g1, h2, g2, long in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5, 6)), strict=True):
            gone, run = [], []
            for i, j in [*patience(list(zip(h1, g1, strict=True)), list(zip(h2, g2, strict=True))), (-2, -2)]:
                if run and (i != run[-1][0] + 1 or j != run[-1][1] + 1):
                    if any(long[y] for _, y in run):
                        gone += [y for _, y in run]
                    run = []
                run.append((i, j))
            out.append(gone)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int32()))], ["d", "k", "gone"])


def _rewrite(fields: list[str]):
    def run(batches):
        for batch in batches:
            texts, n, removed = [], [], []
            for text, gone in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                lines = (text or "").split("\n")
                drop = {i for g in gone or () for i in g}
                texts.append("\n".join(x for i, x in enumerate(lines) if i not in drop))
                n.append(len(lines))
                removed.append(len(drop))
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(texts, pa.string()), pa.array(n, pa.int32()), pa.array(removed, pa.int32())], fields)

    return run


def _stretches(h: np.ndarray, long: np.ndarray, doc: np.ndarray, step: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of short lines with a long one ahead (step 1: after, -1: before), and a hash of the lines from each to it."""
    value, out = h.copy(), []
    at = np.flatnonzero(long)
    while len(at):
        to = at - step
        ok = (to >= 0) & (to < len(h))
        at, to = at[ok], to[ok]
        ok = (doc[to] == doc[at]) & ~long[to]
        at, to = at[ok], to[ok]
        v = value[at]
        value[to] = (h[to] * np.uint64(0x9E3779B97F4A7C15) + (v ^ (v >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) ^ np.uint64(salt)
        out.append(to)
        at = to
    places = np.concatenate(out) if out else at
    return places, value[places]


def _keys(batches):
    """For documents (d, k, h, long): each key with the places it stands for."""
    for batch in batches:
        h = batch.column(2).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        long = batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(bool)
        size = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(len(size)), size)
        start = np.concatenate([[0], np.cumsum(size)])
        found = [(np.flatnonzero(long), h[long]), _stretches(h, long, doc, 1, 0x5851F42D4C957F2D), _stretches(h, long, doc, -1, 0x14057B7EF767814F)]
        place, key = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((place, key, doc[place]))
        place, key = place[order], key[order]
        who = doc[place]
        new = np.flatnonzero((np.diff(who, prepend=-1) != 0) | np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
        ys = pa.ListArray.from_arrays(pa.array(np.append(new, len(place)), pa.int32()), pa.array(place - start[who], pa.int32()))
        at = pa.array(who[new])
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(key[new].view(np.int64)), ys], ["d", "k", "key", "ys"])


def _hashed(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """The rows by d and k, and (d, k, h, g: hashes of the lines, long: which are) of each document once, from disk."""
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("d"), F.xxhash64(text).alias("k"))
    trimmed = F.transform(F.split(_body(), "\n", -1), lambda x: F.regexp_replace(x, r"^[ \t\r\f\x0B]+|[ \t\r\f\x0B]+$", ""))
    hashed = own.select("d", "k", trimmed.alias("lines")).select("d", "k", F.transform("lines", lambda x: F.xxhash64(x)).alias("h"), F.transform("lines", lambda x: F.hash(x)).alias("g"), F.transform("lines", lambda x: F.length(x) >= least).alias("long"))
    return own, cut(hashed.dropDuplicates(["d", "k"]), "lines")


def _body():
    return F.coalesce(F.col("row.text").cast("string"), F.lit(""))


def _align(pairs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(d, k, gone) of each pair (d, k, fd, fk); a first document of many pairs goes to many places."""
    first = distinct.select(F.struct(F.col("d").alias("fd"), F.col("k").alias("fk")).alias("first"), F.col("h").alias("fh"), F.col("g").alias("fg"))
    sides = hub_join(pairs.select("d", "k", F.struct("fd", "fk").alias("first")), first, "first", "k").join(distinct, ["d", "k"])
    return sides.select("d", "k", "fh", "fg", "h", "g", "long").mapInArrow(_delete, "d long, k long, gone array<int>")


def _ranked(keys: DataFrame) -> DataFrame:
    """keys (d, k, key, ys) of at least two documents, with rank from 1 in order of (d, k).

    Documents are cut into ranges; a key is counted in each of them and ranked within them."""
    totals = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    dealt = hub_join(keys, totals, "key", "k").repartitionByRange(4 * parts(keys.sparkSession), "d", "k")
    dealt = cut(dealt.withColumn("range", F.spark_partition_id()), "line-ranges")
    sizes = dealt.groupBy("key", "range").agg(F.count("*").alias("size"))
    before = sizes.select("key", "range", F.coalesce(F.sum("size").over(Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # a row for each range at most
    own = F.row_number().over(Window.partitionBy("key", "range").orderBy("d", "k"))
    return dealt.withColumn("own", own).join(before, ["key", "range"]).select("d", "k", "key", "ys", (F.col("own") + F.col("before")).alias("rank"))


def _kept(own: DataFrame, gone: DataFrame) -> DataFrame:
    gone = gone.groupBy("d", "k").agg(F.collect_list(F.when(F.size("gone") > 0, F.col("gone"))).alias("gone"), F.count("*").cast("int").alias("n_partners"))
    joined = own.join(gone, ["d", "k"], "left").select(_body().alias("text"), "gone", "row", F.coalesce("n_partners", F.lit(0)).alias("n_partners"))
    row = own.schema["row"].dataType.simpleString()
    return joined.mapInArrow(_rewrite(["row", "n_partners", "kept", "n_lines", "n_removed"]), f"row {row}, n_partners int, kept string, n_lines int, n_removed int")


def dedup_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(row: the given columns; kept: the text without deleted lines; n_lines; n_removed; n_partners: documents it was aligned with)."""
    own, hashed = _hashed(docs, least)
    same = hashed.filter(F.exists("long", lambda x: x)).select("d", "k", F.xxhash64("h", "g").alias("c1"), F.xxhash64(F.lit("#"), "h", "g").alias("c2"), F.size("h").alias("n"))
    head = same.groupBy("c1", "c2").agg(F.min(F.struct("d", "k")).alias("head"))
    copies = cut(hub_join(same.select(F.struct("c1", "c2").alias("c"), "d", "k", "n"), head.select(F.struct("c1", "c2").alias("c"), "head"), "c", "k").filter(F.struct("d", "k") != F.col("head")).select("d", "k", "n"), "line-copies")
    rest = hashed.filter(F.exists("long", lambda x: x)).join(copies, ["d", "k"], "left_anti").select("d", "k", "h", "long")
    keys = rest.mapInArrow(_keys, "d long, k long, key long, ys array<int>")
    held = cut(_ranked(keys), "line-keys")
    need, tried, found, low, high = held.filter("rank > 1"), None, [], 1, 1
    while True:
        holders = held.filter(F.col("rank").between(low, high)).select("key", F.col("d").alias("fd"), F.col("k").alias("fk"), F.col("rank").alias("before"))
        pairs = hub_join(need, holders, "key", "k").filter("before < rank").select("d", "k", "fd", "fk").distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["d", "k", "fd", "fk"], "left_anti")
        pairs = cut(pairs, "line-pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        found.append(cut(_align(pairs, hashed), "line-gone"))
        gone = found[-1].filter(F.size("gone") > 0).groupBy("d", "k").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))
        left = need.filter(F.col("rank") > high + 1).join(gone, ["d", "k"], "left")
        left = left.select("key", "d", "k", F.when(F.col("gone").isNull(), F.col("ys")).otherwise(F.array_except("ys", "gone")).alias("ys"), "rank").filter(F.size("ys") > 0)
        need = cut(left, "line-need")
        if need.isEmpty():
            break
        low, high = high + 1, 2 * high + 1
    gone = copies.select("d", "k", F.sequence(F.lit(0), F.col("n") - 1).alias("gone"))
    for part in found:
        gone = gone.unionByName(part)
    return _kept(own, gone)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = dedup_lines(docs)
    return out.select("row.doc_id", "n_lines", F.col("n_removed").alias("n_removed_lines"), "n_partners", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
