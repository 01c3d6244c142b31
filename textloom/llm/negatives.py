"""Hard-negative mining by a full sort of each anchor's scores.

Components become integers (floor of 256 x), a row's score is its integer inner product with the anchor.
Anchors (in groups of a bounded number) meet the blocks of all rows in the cells of a grid; each cell scores
whole blocks, sorts every anchor's scores by lexsort (score descending, id ascending) and keeps the few rows
wanted so far, so that neither side is gathered and a cell's memory is bounded.  The first pass gives each
anchor its positives: the first rows of its label.  The second searches the sorted scores for each positive's
upper limit and reads the first rows of other labels from there down to its lower limit.  Cells' rows are
ranked anew across cells.

Defined results: rows with a null vec_id or label or a vector that is null, empty or holds null or non-finite
components take no part.  Vectors of different lengths don't meet.  A row repeated under one vec_id is a
candidate as often as it stands there, each row of a repeated anchor mines for itself, and rows of an
anchor's own vec_id are never its positives.  An anchor without a positive gives no rows, nor does a positive
without a negative within its limits (so none below zero).  Components from 2^16 on raise an error.  No rows
give no rows.  Other columns don't pass through.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.llm.shared import cut, parts, prepare, whole_matrix, whole_vector

BLOCK, ANCHORS, GROUP, HELD = 2048, 256, 32, 1 << 18


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows: by doubles where no sum can leave 2^53."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _pack(size: int, extra: list[tuple[str, str]]):
    """Rows (len, vec_id, label, v, more long columns) as blocks of at most `size` rows of one length."""

    def pack(table):
        return pa.RecordBatch.from_arrays(
            [pa.array([table.column("len")[0].as_py()], pa.int32())]
            + [pa.array([table.column(c).to_numpy().astype("<i8").tobytes()], pa.binary()) for c in ("vec_id", "label")]
            + [pa.array([whole_matrix(table.column("v")).astype("<i4").tobytes()], pa.binary())]
            + [pa.array([np.asarray(table.column(c).combine_chunks().flatten() if many else table.column(c)).astype("<i8").tobytes()], pa.binary()) for c, many in extra],
            ["len", "ids", "labels", "vectors", *(c for c, _ in extra)],
        )

    def run(batches):
        held = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            lengths = np.asarray(batch.column("len"))
            for n in np.unique(lengths).tolist():
                some = table.filter(pa.array(lengths == n))
                own = pa.concat_tables([held[n], some]) if n in held else some
                while own.num_rows >= size:
                    yield pack(own.slice(0, size).combine_chunks())
                    own = own.slice(size)
                held[n] = own
        for own in held.values():
            if own.num_rows:
                yield pack(own.combine_chunks())

    return run


PACKED = "len int, ids binary, labels binary, vectors binary"


def _best(key: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k rows of each key that come first: higher scores, then smaller ids."""
    order = np.lexsort((ids, -score, key))
    if not len(order):
        return order
    key = key[order]
    start = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], np.arange(len(key)), 0))
    return order[np.arange(len(key)) - start < k]


class _Kept:
    """The first k rows of each key so far."""

    def __init__(self, k: int):
        self.k, self.n, self.rows = k, 0, []

    def add(self, key, score, ids):
        self.rows.append((key, score, ids))
        self.n += len(key)
        if self.n > HELD:
            self.prune()

    def prune(self):
        key, score, ids = (np.concatenate(x) for x in zip(*self.rows, strict=True)) if self.rows else (np.empty(0, np.int64),) * 3
        at = _best(key, score, ids, self.k)
        self.rows, self.n = [(key[at], score[at], ids[at])], 0  # what is left is bounded by k rows a key

    def batches(self):
        self.prune()
        key, score, ids = self.rows[0]
        for i in range(0, len(key), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(x[i : i + (1 << 16)]) for x in (key, score, ids)], ["key", "score", "id"])


def _cells(found, k: int, extra: list[str]):
    """Rows sorted by cell (g, col): the anchors' blocks, then the rows' blocks; found() gives (key, score, id) of a pair."""

    def block(r: dict) -> dict:
        ids = np.frombuffer(r["ids"], "<i8")
        return {"ids": ids, "labels": np.frombuffer(r["labels"], "<i8"), "x": np.frombuffer(r["vectors"], "<i4").astype(np.int64).reshape(len(ids), -1), **{c: np.frombuffer(r[c], "<i8") for c in extra if r[c] is not None}}

    def run(batches):
        now, anchors, kept = None, [], None
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if (r["g"], r["col"]) != now:
                    if kept:
                        yield from kept.batches()
                    now, anchors, kept = (r["g"], r["col"]), [], _Kept(k)
                b = block(r)
                if r["anchor"]:
                    anchors.append(b)
                else:
                    for a in anchors:
                        if a["x"].shape[1] == b["x"].shape[1]:
                            kept.add(*found(a, b))
        if kept:
            yield from kept.batches()

    return run


def _sorted(a: dict, b: dict) -> tuple[np.ndarray, np.ndarray]:
    """Each anchor's scores with the block's rows, and their order: higher scores, then smaller ids."""
    score = _scores(a["x"], b["x"])
    return score, np.lexsort((np.broadcast_to(b["ids"], score.shape), -score))


def _positives(k: int):
    def found(a: dict, b: dict):
        score, order = _sorted(a, b)
        same = (b["labels"][order] == a["labels"][:, None]) & (b["ids"][order] != a["ids"][:, None])
        row, at = np.nonzero(same & (np.cumsum(same, 1) <= k))
        col = order[row, at]
        return a["key"][row], score[row, col], b["ids"][col]

    return found


def _negatives(k: int, low: int, high: int, most: int):
    """Keys are anchor * most + the positive's place."""

    def found(a: dict, b: dict):
        score, order = _sorted(a, b)
        falling = -np.take_along_axis(score, order, 1)
        other = b["labels"][order] != a["labels"][:, None]
        keys, cols, rows, first = [], [], [], 0
        for i, n in enumerate(a["counts"].tolist()):
            upper = a["scores"][first : first + n]
            first += n
            start = np.searchsorted(falling[i], -upper, "left")
            end = np.searchsorted(falling[i], low * upper // -high, "right")  # score >= low / high * upper, so -score <= its floored negative
            at = np.flatnonzero(other[i])
            start, end = np.searchsorted(at, start), np.searchsorted(at, end)
            for j, (s, e) in enumerate(zip(start.tolist(), np.minimum(end, start + k).tolist(), strict=True)):
                if s < e:
                    cols.append(order[i, at[s:e]])
                    rows.append(np.full(e - s, i))
                    keys.append(np.full(e - s, a["key"][i] * most + j))
        if not keys:
            return (np.empty(0, np.int64),) * 3
        row, col = np.concatenate(rows), np.concatenate(cols)
        return np.concatenate(keys), score[row, col], b["ids"][col]

    return found


def _meet(anchors: DataFrame, blocks: DataFrame, found, k: int, extra: list[str]) -> DataFrame:
    """(key, score, id, rank): the first k rows of each key over all cells.  anchors and blocks are tables of blocks."""
    p = parts(blocks.sparkSession)
    groups = max(1, -(-anchors.count() // GROUP))
    cols = max(1, -(-2 * p // groups))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    deal = lambda n: F.pmod(F.xxhash64("ids", "vectors"), F.lit(n)).cast("int")
    a = anchors.withColumn("anchor", F.lit(True)).withColumn("g", deal(groups)).withColumn("col", every(cols))
    b = blocks.withColumn("anchor", F.lit(False)).withColumn("col", deal(cols)).withColumn("g", every(groups))
    dealt = a.unionByName(b, allowMissingColumns=True).repartition(groups * cols, "g", "col").sortWithinPartitions("g", "col", F.col("anchor").desc())
    got = dealt.mapInArrow(_cells(found, k, extra), "key long, score long, id long")
    w = Window.partitionBy("key").orderBy(F.col("score").desc(), "id")
    return got.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of rows (vec_id, embedding, label).

    Anchors are the rows where `anchor` holds.  Of each of an anchor's first `positives` rows of its label, the
    first `negatives` rows of other labels with low * positive_score <= high * negative_score <= high * positive_score."""
    if not 0 < low <= high or positives < 1 or negatives < 1:
        raise ValueError("0 < low <= high, and at least one positive and one negative")
    prepare(rows.sparkSession)
    low, high = low // math.gcd(low, high), high // math.gcd(low, high)
    marked = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole_vector(F.col("embedding")).alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    marked = marked.filter("vec_id is not null and label is not null and v is not null").withColumn("len", F.size("v"))
    blocks = cut(marked.select("len", "vec_id", "label", "v").mapInArrow(_pack(BLOCK, []), PACKED), "negative-rows")
    # a key for each anchor row, fixed by the table
    anchors = cut(marked.filter("anchor").select("len", "vec_id", "label", "v", F.monotonically_increasing_id().alias("key")), "negative-anchors")
    packed = cut(anchors.mapInArrow(_pack(ANCHORS, [("key", False)]), PACKED + ", key binary"), "negative-anchor-blocks")
    first = _meet(packed, blocks, _positives(positives), positives, ["key"])
    first = first.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rank", "score", "id"))).alias("p"))  # at most `positives` of each
    first = cut(first.select("key", F.transform("p", lambda x: x["score"]).alias("scores"), F.transform("p", lambda x: x["id"]).alias("positives")), "positives")
    asking = anchors.join(first.select("key", "scores", F.size("scores").cast("long").alias("counts")), "key")
    packed = cut(asking.select("len", "vec_id", "label", "v", "key", "scores", "counts").mapInArrow(_pack(ANCHORS, [("key", False), ("scores", True), ("counts", False)]), PACKED + ", key binary, scores binary, counts binary"), "negative-askers")
    got = _meet(packed, blocks, _negatives(negatives, low, high, positives), negatives, ["key", "scores", "counts"])
    got = got.select(F.floor(F.col("key") / positives).alias("key"), (F.pmod("key", F.lit(positives))).cast("int").alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = anchors.select("key", F.col("vec_id").alias("anchor_id")).join(first, "key")
    return got.join(named, "key").select("anchor_id", F.get("positives", "place").alias("positive_id"), "rank", "negative_id", F.get("scores", "place").alias("positive_score"), "negative_score")


def query(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


#: The same for tables of distinct vec_ids and vectors of one length.
SQL = """WITH k AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score FROM k a, k b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s USING (anchor_id, own) WHERE label <> own AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT * FROM n WHERE rank <= 5"""
