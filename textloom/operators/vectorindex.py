"""A stored vector index: inverted lists of short codes, searched by the lists nearest to a query.

Centroids are fitted on a bounded sample (about SAMPLE rows, by a hash of the key) and every row goes to the
list of its nearest one.  A list holds codes of four bits a component: what is left of a vector after its
centroid, turned by a fixed rotation.  A search compares codes of the lists probed, in blocks, keeps the
best `rerank` rows of a query and scores only these in full.  How many lists are probed is measured when the
index is built: the exact nearest rows of CALIBRATION sampled rows, found by a whole scan, give the recall of
each number of probes, and the least one that reaches the target is kept.

Scores are inner products, so cosines of unit vectors.  Rows whose vector is null, empty or holds null or
non-finite components, or has another length than most, are counted as skipped; every other row is indexed,
repeats too.  The folder holds vectors, lists, centroids, curve and, written last, meta; add() appends rows.
Centroids reach every task: at most MOST_LISTS of them, whatever the rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import vectors as V
from textloom.operators.lineage import small_batches, stored
from textloom.operators.retrieve import grid, nearest, top

SAMPLE, CALIBRATION, MOST_LISTS = 65_536, 256, 8_192
BLOCK, HELD = 1024, 1 << 19
SENT = 1 << 30  # bytes that a search by lists may send whatever a grid takes
CELL, LEAST_SIDE, MOST_SIDE = 1 << 26, 4, 12  # of the grid in which found pairs are scored in full


@dataclass
class VectorIndex:
    """vectors (row, doc_key, v, list), lists (list, rows, codes, scales), curve (probes, recall), and what meta says."""

    path: str
    vectors: DataFrame
    lists: DataFrame
    curve: DataFrame
    centroids: np.ndarray
    dims: int
    probes: int
    n_rows: int
    n_skipped: int
    seed: int


def _rotation(dims: int, seed: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))[0]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def pack_codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows as four-bit steps of a scale of their own: (bytes, scales)."""
    scale = np.abs(x).max(1, initial=0) / 7.5
    q = np.clip(np.rint(x / np.where(scale == 0, 1, scale)[:, None] + 7.5), 0, 15).astype(np.uint8)
    q = np.pad(q, ((0, 0), (0, q.shape[1] % 2)))
    return q[:, ::2] | q[:, 1::2] << 4, scale.astype(np.float32)


def unpack_codes(codes: np.ndarray, scale: np.ndarray, dims: int) -> np.ndarray:
    q = np.empty((len(codes), 2 * codes.shape[1]), np.float32)
    q[:, ::2], q[:, 1::2] = codes & 15, codes >> 4
    return (q[:, :dims] - 7.5) * scale[:, None]


def _assign(centroids, half):
    """Adds each row's list: its nearest centroid."""

    def run(batches):
        c, h = centroids.value, half
        for batch in batches:
            x = _matrix(batch.column("v"))
            at = np.concatenate([(x[i : i + BLOCK] @ c.T - h).argmax(1) for i in range(0, len(x), BLOCK)] or [np.empty(0, np.int64)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32))], [*batch.schema.names, "list"])

    return run


def _pack(centroids, dims: int, seed: int):
    """Rows sorted by list as blocks of at most BLOCK rows of one list."""

    def run(batches):
        c, turn, held = centroids.value, _rotation(dims, seed), None

        def block(table):
            at = table.column("list")[0].as_py()
            codes, scales = pack_codes((_matrix(table.column("v").combine_chunks()) - c[at]) @ turn)
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([np.asarray(table.column("row"), "<i8").tobytes()], pa.binary()), pa.array([codes.tobytes()], pa.binary()), pa.array([scales.astype("<f4").tobytes()], pa.binary())], ["list", "rows", "codes", "scales"])

        for batch in batches:
            held = pa.concat_tables([held, pa.Table.from_batches([batch])]) if held is not None else pa.Table.from_batches([batch])
            while held.num_rows:
                lists = np.asarray(held.column("list"))
                end = min(int(np.searchsorted(lists, lists[0], "right")), BLOCK)
                if end == held.num_rows and end < BLOCK:
                    break
                yield block(held.slice(0, end))
                held = held.slice(end)
        if held is not None and held.num_rows:
            yield block(held)

    return run


def _write(spark: SparkSession, rows: DataFrame, path: str, centroids: np.ndarray, dims: int, seed: int, first: int, mode: str) -> None:
    """vectors and lists of usable rows (doc_key, v); row numbers are fixed by the stored vectors and start at `first`."""
    small_batches(spark)
    sent = spark.sparkContext.broadcast(centroids)
    half = (centroids * centroids).sum(1) / 2
    kind = rows.schema["doc_key"].dataType.simpleString()
    named = rows.select((F.monotonically_increasing_id() + F.lit(first)).alias("row"), "doc_key", F.col("v").cast("array<double>").alias("v"))
    named.mapInArrow(_assign(sent, half), f"row long, doc_key {kind}, v array<double>, list int").write.mode(mode).parquet(f"{path}/vectors")
    new = spark.read.parquet(f"{path}/vectors").filter(F.col("row") >= first).select("list", "row", "v")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = new.repartitionByRange(parts, "list", "row").sortWithinPartitions("list", "row")  # a long list is parted by row
    dealt.mapInArrow(_pack(sent, dims, seed), "list int, rows binary, codes binary, scales binary").write.mode(mode).parquet(f"{path}/lists")


def _ranks(centroids):
    """Of rows (v, near: lists of the exact nearest rows): at which probe each of those lists comes."""

    def run(batches):
        c = centroids.value
        for batch in batches:
            place = np.argsort(np.argsort(-(_matrix(batch.column("v")) @ c.T), axis=1, kind="stable"), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array([p[np.array(n, int)].tolist() for p, n in zip(place, batch.column("near").to_pylist(), strict=True)], pa.list_(pa.int64()))], ["places"])

    return run


def _curve(spark: SparkSession, path: str, rows: DataFrame, centroids: np.ndarray, n: int, k: int, seed: int) -> np.ndarray:
    """The share of the exact k nearest rows that each number of probes reaches, over about CALIBRATION sampled rows."""
    some = stored(_sampled(rows, CALIBRATION, n, seed + 1).select(F.col("doc_key").alias("query_id"), "v"), "calibration")
    near = nearest(some, rows, k, skip_self=True).select("query_id", "doc_key")
    lists = near.join(spark.read.parquet(f"{path}/vectors").select("doc_key", "list"), "doc_key").groupBy("query_id").agg(F.collect_list("list").alias("near"))  # k for each query
    places = some.join(lists, "query_id").select("v", "near").mapInArrow(_ranks(spark.sparkContext.broadcast(centroids)), "places array<long>")
    counts = {r.p: r.n for r in places.select(F.explode("places").alias("p")).groupBy("p").agg(F.count("*").alias("n")).collect()}  # a row for each list at most
    found = np.cumsum([counts.get(i, 0) for i in range(len(centroids))])
    return found / found[-1] if len(found) and found[-1] else np.ones(len(centroids))


def _sampled(rows: DataFrame, size: int, n: int, seed: int) -> DataFrame:
    """About `size` of n rows, by a hash of the key."""
    return rows if n <= size else rows.filter(F.pmod(F.xxhash64(F.lit(seed), "doc_key"), F.lit(1 << 40)) < int((1 << 40) * size / n))


def build_vector_index(rows: DataFrame, path: str, n_lists: int | None = None, k: int = 10, recall: float = 0.9, seed: int = 42) -> VectorIndex:
    """Write the index of rows (doc_key, v) below path and load it.  Lists: by default the root of the rows' number.
    recall: what probing must reach for k rows, half of what is missing added for the codes."""
    spark = rows.sparkSession
    sizes = rows.groupBy(F.when(V.usable("v"), F.size("v")).alias("dims")).agg(F.count("*").alias("n")).collect()  # a row for each length
    n, dims = max(((r.n, r.dims) for r in sizes if r.dims), default=(0, 0))
    good = rows.filter(V.usable("v") & (F.size("v") == dims)).select("doc_key", F.col("v").cast("array<double>").alias("v"))
    lists = min(n_lists or max(1, math.isqrt(n)), MOST_LISTS, max(n, 1))
    if n:
        sample = stored(_sampled(good, SAMPLE, n, seed).select(array_to_vector("v").alias("features")), "index-sample")
        centroids = np.zeros((1, dims))
        if lists > 1:
            model = KMeans(k=lists, initMode="random", maxIter=8, seed=seed).fit(sample)
            centers = np.array(model.clusterCenters())  # fewer than asked where rows repeat
            centroids = centers[np.array(model.summary.clusterSizes[: len(centers)]) > 0]  # an empty list would only take up probes
    else:
        centroids = np.zeros((0, dims))
    _write(spark, good, path, centroids, dims, seed, 0, "overwrite")
    curve = _curve(spark, path, good, centroids, n, k, seed) if n else np.ones(0)
    probes = int(np.searchsorted(curve, recall + (1 - recall) / 2)) + 1
    spark.createDataFrame([(i + 1, float(r)) for i, r in enumerate(curve)], "probes int, recall double").coalesce(1).write.mode("overwrite").parquet(f"{path}/curve")
    spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centroids)], "list int, centroid array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
    _meta(spark, path, dims, min(probes, max(1, len(centroids))), n, sum(r.n for r in sizes) - n, seed)
    return load_vector_index(spark, path)


def _meta(spark: SparkSession, path: str, *values: int) -> None:
    spark.createDataFrame([values], "dims int, probes int, n_rows long, n_skipped long, seed int").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def load_vector_index(spark: SparkSession, path: str) -> VectorIndex:
    m = spark.read.parquet(f"{path}/meta").first()
    centroids = [r.centroid for r in spark.read.parquet(f"{path}/centroids").orderBy("list").collect()]  # MOST_LISTS at most
    return VectorIndex(path, *(spark.read.parquet(f"{path}/{t}") for t in ("vectors", "lists", "curve")), np.array(centroids).reshape(len(centroids), m.dims), m.dims, m.probes, m.n_rows, m.n_skipped, m.seed)


def add(index: VectorIndex, rows: DataFrame) -> VectorIndex:
    """The index with more rows (doc_key, v), appended to its lists; centroids and probes stay.  An index without centroids takes none: build it anew."""
    if not len(index.centroids):
        raise ValueError("an index of no rows has no lists; build it with rows")
    spark = rows.sparkSession
    rows = stored(rows.select("doc_key", "v"), "index-more")
    good = rows.filter(V.usable("v") & (F.size("v") == index.dims))
    first = (index.vectors.agg(F.max("row")).first()[0] or 0) + 1
    n, fine = rows.count(), good.count()
    _write(spark, good, index.path, index.centroids, index.dims, index.seed, first, "append")
    _meta(spark, index.path, index.dims, index.probes, index.n_rows + fine, index.n_skipped + n - fine, index.seed)
    return load_vector_index(spark, index.path)


def _probe(centroids, probes: int, dims: int, seed: int):
    """Rows (q, v) as (list, q, turned vectors, products with the centroid): a row for each list that a batch's queries probe."""

    def run(batches):
        c, turn = centroids.value, _rotation(dims, seed)
        for batch in batches:
            x, q = _matrix(batch.column("v")), np.asarray(batch.column("q"))
            with_c, turned = x @ c.T, x @ turn
            first = np.argsort(-with_c, axis=1, kind="stable")[:, :probes]
            who, at = np.repeat(np.arange(len(x)), first.shape[1]), first.ravel()
            order = np.argsort(at, kind="stable")
            starts = np.flatnonzero(np.r_[True, np.diff(at[order]) != 0]) if len(order) else []
            for group in np.split(order, starts[1:]) if len(order) else []:
                some, one = who[group], int(at[group[0]])
                yield pa.RecordBatch.from_arrays([pa.array([one], pa.int32())] + [pa.array([v.tobytes()], pa.binary()) for v in (q[some].astype("<i8"), turned[some].astype("<f4"), with_c[some, one].astype("<f8"))], ["list", "q", "turned", "base"])

    return run


def _best(q, row, score, k: int):
    """The k best scores of each q."""
    order = np.lexsort((row, -score, q))
    q = q[order]
    start = np.maximum.accumulate(np.where(np.r_[True, q[1:] != q[:-1]], np.arange(len(q)), 0)) if len(q) else q
    keep = order[np.arange(len(q)) - start < k]
    return keep


class _Kept:
    """Each query's k best of the rows given so far.  A query's bar is a score that k of its rows reach, so a row below it is no longer taken."""

    def __init__(self, k: int):
        self.k, self.parts, self.n, self.asked, self.bars = k, [], 0, np.empty(0, np.int64), np.empty(0)

    def add(self, q, row, score) -> None:
        """Scores of distinct queries (down) and rows (across)."""
        at = np.minimum(np.searchsorted(self.asked, q), max(0, len(self.asked) - 1))
        bar = np.where(self.asked[at] == q, self.bars[at], -np.inf) if len(self.asked) else np.full(len(q), -np.inf)
        fit = score >= bar[:, None]  # few pass a bar, so only what is left is ranked
        many = np.flatnonzero(np.count_nonzero(fit, axis=1) > self.k)
        if len(many):
            best = np.argpartition(-score[many], self.k - 1, axis=1)[:, : self.k]
            fit[many] = False
            fit[many[:, None], best] = True
        down, across = np.divmod(np.flatnonzero(fit), fit.shape[1])
        self.parts.append((q[down], row[across], score[down, across].astype(np.float64)))
        self.n += len(down)

    def merge(self) -> None:
        q, row, score = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        at = _best(q, row, score, self.k)
        q, row, score = q[at], row[at], score[at]
        ends = np.r_[np.flatnonzero(q[1:] != q[:-1]), len(q) - 1] if len(q) else np.empty(0, np.int64)
        full = ends[np.diff(np.r_[-1, ends]) == self.k]
        asked, bars = np.r_[self.asked, q[full]], np.r_[self.bars, score[full]]
        order = np.lexsort((-bars, asked))  # the higher of a query's two bars comes first
        self.asked, first = np.unique(asked[order], return_index=True)
        self.bars, self.parts, self.n = bars[order][first], [(q, row, score)], len(q)

    def out(self):
        """What is held, as batches; the bars stay."""
        if self.parts:
            self.merge()
            rows, self.parts, self.n = self.parts[0], [], 0
            for i in range(0, len(rows[0]), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(x[i : i + (1 << 16)]) for x in rows], ["q", "row", "score"])


def _block(batch, i: int, dims: int):
    row = np.frombuffer(batch.column("rows")[i].as_py(), "<i8")
    return row, unpack_codes(np.frombuffer(batch.column("codes")[i].as_py(), np.uint8).reshape(len(row), -1), np.frombuffer(batch.column("scales")[i].as_py(), "<f4"), dims)


def _compare(dims: int, k: int):
    """Of pairs of a list's queries and one of its blocks: each query's k best rows by code, over all that a task sees."""

    def run(batches):
        kept, more = _Kept(k), HELD
        for batch in batches:
            for i in range(batch.num_rows):
                q, turned, base = (np.frombuffer(batch.column(n)[i].as_py(), t) for n, t in (("q", "<i8"), ("turned", "<f4"), ("base", "<f8")))
                row, x = _block(batch, i, dims)
                kept.add(q, row, turned.reshape(len(q), dims) @ x.T + base[:, None])
                if kept.n > more:
                    kept.merge()
                    if kept.n > HELD:  # very many queries: what they have so far goes on as it is
                        yield from kept.out()
                    more = kept.n + HELD
        yield from kept.out()

    return run


def _bundles(most: int):
    """Rows (q, v) as bundles of at most `most` queries."""

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, most):
                part = batch.slice(i, most)
                yield pa.RecordBatch.from_arrays([pa.array([np.asarray(part.column("q"), "<i8").tobytes()], pa.binary()), pa.array([_matrix(part.column("v")).astype("<f8").tobytes()], pa.binary())], ["q", "v"])

    return run


def _compare_bundles(centroids, probes: int, dims: int, seed: int, k: int):
    """Of a cell's blocks (kind 0) and bundles (kind 1), in this order: each query's k best rows by code in the lists that it probes.
    The cell's blocks are held as they are stored; k rows of a query leave the task."""

    def run(batches):
        c, turn, now = centroids.value, _rotation(dims, seed), None
        for batch in batches:
            for i in range(batch.num_rows):
                if (cell := batch.column("cell")[i].as_py()) != now:
                    now, blocks = cell, []
                if batch.column("kind")[i].as_py() == 0:
                    blocks.append(batch.slice(i, 1))
                    continue
                kept, q = _Kept(k), np.frombuffer(batch.column("q")[i].as_py(), "<i8")
                x = np.frombuffer(batch.column("v")[i].as_py(), "<f8").reshape(len(q), dims)
                with_c, turned = x @ c.T, (x @ turn).astype("<f4")
                first = np.argsort(-with_c, axis=1, kind="stable")[:, :probes]
                probed = np.zeros(with_c.shape, bool)
                np.put_along_axis(probed, first, True, 1)
                more = step = min(HELD, 3 * k * len(q))  # the first bars come early
                for held in blocks:
                    at = held.column("list")[0].as_py()
                    who = np.flatnonzero(probed[:, at])
                    if len(who):
                        row, y = _block(held, 0, dims)
                        kept.add(q[who], row, turned[who] @ y.T + with_c[who, at][:, None])
                        if kept.n > more:
                            kept.merge()
                            more = kept.n + step
                yield from kept.out()

    return run


def _pairs(index: VectorIndex, queries: DataFrame, probes: int | None) -> tuple[DataFrame, DataFrame]:
    """(stored queries (q, query_id, v), (q, row-blocks) that meet)."""
    small_batches(queries.sparkSession)
    good = queries.filter(V.usable("v") & (F.size("v") == index.dims)).select(F.monotonically_increasing_id().alias("q"), "query_id", F.col("v").cast("array<double>").alias("v"))
    asked = stored(good, "vector-queries")
    return asked, _probed(index, asked, probes or index.probes).join(index.lists.hint("merge"), "list")  # Spark takes what Python makes of the queries for small and would broadcast it


def _probed(index: VectorIndex, asked: DataFrame, probes: int) -> DataFrame:
    sent = asked.sparkSession.sparkContext.broadcast(index.centroids)
    return asked.select("q", "v").mapInArrow(_probe(sent, probes, index.dims, index.seed), "list int, q binary, turned binary, base binary")


def _near(index: VectorIndex, asked: DataFrame, pairs: DataFrame, probes: int, k: int) -> DataFrame:
    """(q, row, score): by code the k best rows of each query are among them.  Where few lists are probed, a list's queries meet
    its blocks.  Where half of them are or more, or what is sent for each list is much and more than a grid takes: bundles of queries
    and blocks then meet in a bounded grid instead, as in nearest()."""
    spark, kind = asked.sparkSession, "q long, row long, score double"
    n = asked.count()
    query, block = n * (8 * index.dims + 24 * k), index.n_rows * (index.dims // 2 + 12)
    down, across = grid(query, block, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if 2 * probes < len(index.centroids) and n * probes * (4 * index.dims + 16 + 24 * k) <= max(SENT, across * query + down * block):
        return pairs.mapInArrow(_compare(index.dims, k), kind)
    most = max(1, min(BLOCK, HELD // k))
    across = max(across, min(MOST_SIDE, -(-block // CELL)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cell = (F.col("down") * across + F.col("across")).alias("cell")
    bundles = asked.select("q", "v").mapInArrow(_bundles(min(most, max(1, -(-n // down)))), "q binary, v binary")
    bundles = bundles.withColumn("down", F.pmod(F.xxhash64("q"), F.lit(down)).cast("int")).withColumn("across", every(across)).select(cell, F.lit(1).alias("kind"), "q", "v")
    blocks = index.lists.withColumn("across", F.pmod(F.xxhash64("rows"), F.lit(across)).cast("int")).withColumn("down", every(down)).select(cell, F.lit(0).alias("kind"), "list", "rows", "codes", "scales")
    sent = spark.sparkContext.broadcast(index.centroids)
    cells = blocks.unionByName(bundles, allowMissingColumns=True).repartition(down * across, "cell").sortWithinPartitions("cell", "kind")
    return cells.mapInArrow(_compare_bundles(sent, probes, index.dims, index.seed, k), kind)


def _dealt(part: Callable, columns: Callable):
    """Each batch's rows by part (batch: an int for each row), as one row of a part's columns."""

    def run(batches):
        for batch in batches:
            at = part(batch)
            order = np.argsort(at, kind="stable")
            for group in np.split(order, np.flatnonzero(np.diff(at[order])) + 1) if len(order) else []:
                yield pa.RecordBatch.from_pydict({"part": pa.array([int(at[group[0]])], pa.int32())} | columns(batch.take(pa.array(group))))

    return run


def _exact(dims: int):
    """Of a cell's queries (kind 0), rows (kind 1) and pairs (kind 2), in this order: every pair's inner product, summed in order of the components."""

    def run(batches):
        now = None
        for batch in batches:
            for i in range(batch.num_rows):
                cell, kind = batch.column("cell")[i].as_py(), batch.column("kind")[i].as_py()
                if cell != now:
                    now, held, sides = cell, ([], []), [None, None]
                a, b = (batch.column(c)[i].as_py() for c in ("a", "b"))
                if kind < 2:
                    held[kind].append((np.frombuffer(a, "<i8"), np.frombuffer(b, "<f8").reshape(-1, dims), batch.column(("query_id", "doc_key")[kind])[i].values))
                    continue
                for side in (0, 1):
                    if sides[side] is None:
                        n = np.concatenate([x[0] for x in held[side]])
                        order = np.argsort(n)
                        sides[side] = n[order], order, np.concatenate([x[1] for x in held[side]]), pa.concat_arrays([x[2] for x in held[side]])
                        held[side].clear()
                (q, x, names), (row, y, keys) = ((order[np.searchsorted(n, np.frombuffer(p, "<i8"))], v, k) for p, (n, order, v, k) in zip((a, b), sides, strict=True))
                for j in range(0, len(q), 1 << 14):
                    left, right = x[q[j : j + (1 << 14)]], y[row[j : j + (1 << 14)]]
                    score = np.zeros(len(left))
                    for d in range(dims):
                        score += left[:, d] * right[:, d]
                    yield pa.RecordBatch.from_arrays([names.take(pa.array(q[j : j + (1 << 14)])), keys.take(pa.array(row[j : j + (1 << 14)])), pa.array(score)], ["query_id", "doc_key", "score"])

    return run


def _in_full(index: VectorIndex, asked: DataFrame, near: DataFrame) -> DataFrame:
    """(query_id, doc_key, score) of pairs (q, row).  A pair's two vectors aren't joined to it: queries and rows are dealt in a grid, about CELL bytes of
    each in a cell, and pairs, two numbers each, go to their cell.  So a vector is copied along a side of the grid, not for each pair."""
    dims, n = index.dims, asked.count()
    down, across = (min(MOST_SIDE, max(LEAST_SIDE, -(-rows * 8 * dims // CELL))) for rows in (n, index.n_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    kinds = {"query_id": asked.schema["query_id"].dataType.simpleString(), "doc_key": index.vectors.schema["doc_key"].dataType.simpleString()}
    whole = lambda x: pa.array([np.asarray(x, "<i8").tobytes()], pa.binary())
    arrays = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
    number = lambda batch, name, parts: np.asarray(batch.column(name)) * 0x9E3779B1 % (1 << 32) * parts >> 32

    def vectors(rows, number_, name, parts):
        columns = lambda b: {"a": whole(b.column(number_)), "b": pa.array([_matrix(b.column("v")).astype("<f8").tobytes()], pa.binary()), name: arrays(b.column(name))}
        return rows.select(number_, name, "v").mapInArrow(_dealt(lambda b: number(b, number_, parts), columns), f"part int, a binary, b binary, {name} array<{kinds[name]}>")

    q = vectors(asked, "q", "query_id", down).withColumn("side", every(across)).select((F.col("part") * across + F.col("side")).alias("cell"), F.lit(0).alias("kind"), "a", "b", "query_id")
    d = vectors(index.vectors, "row", "doc_key", across).withColumn("side", every(down)).select((F.col("side") * across + F.col("part")).alias("cell"), F.lit(1).alias("kind"), "a", "b", "doc_key")
    pairs = near.select("q", "row").mapInArrow(_dealt(lambda b: number(b, "q", down) * across + number(b, "row", across), lambda b: {"a": whole(b.column("q")), "b": whole(b.column("row"))}), "part int, a binary, b binary")
    pairs = pairs.select(F.col("part").alias("cell"), F.lit(2).alias("kind"), "a", "b")
    cells = q.unionByName(d, allowMissingColumns=True).unionByName(pairs, allowMissingColumns=True).repartition("cell").sortWithinPartitions("cell", "kind")
    return cells.mapInArrow(_exact(dims), f"query_id {kinds['query_id']}, doc_key {kinds['doc_key']}, score double")


def _compared(index: VectorIndex, asked: DataFrame, probes: int) -> DataFrame:
    """One row: how many pairs of a query and a row have their codes compared, from each list's queries and rows; no vector is shuffled."""
    ours = _probed(index, asked, probes).groupBy("list").agg(F.sum(F.length("q") / 8).alias("n_queries"))
    theirs = index.lists.groupBy("list").agg(F.sum(F.length("rows") / 8).alias("n_rows"))
    return ours.join(theirs, "list").agg(F.sum(F.col("n_queries") * F.col("n_rows")).alias("codes"))


def search(index: VectorIndex, queries: DataFrame, k: int, probes: int | None = None, rerank: int | None = None, skip_self: bool = False) -> DataFrame:
    """(query_id, doc_key, score, rank) of queries (query_id, v), as retrieve.nearest gives them, for the rows that are
    found.  probes: how many lists a query reads (the measured number by default); rerank: how many rows of a query
    are scored in full (4 k, 40 at least).  Queries without a usable vector of the index's length have no rows."""
    wanted = rerank or max(4 * k, 40)
    if wanted < k + skip_self:
        raise ValueError("rerank is at least k, and one more where the row itself is left out")
    asked, pairs = _pairs(index, queries, probes)
    near = top(_near(index, asked, pairs, probes or index.probes, wanted), wanted, places=12, key="row", group="q").select("q", "row")
    full = _in_full(index, asked, near)
    if skip_self:
        full = full.filter(F.col("query_id") != F.col("doc_key"))
    return top(full, k).select("query_id", "doc_key", "score", "rank")


def report(index: VectorIndex, queries: DataFrame, k: int, probes: int | None = None, rerank: int | None = None) -> DataFrame:
    """One row: indexed rows, queries, recall of search against a whole scan, and the shares of all pairs of a query
    and a row whose codes were compared and which were scored in full."""
    asked, _ = _pairs(index, queries, probes)
    wanted = rerank or max(4 * k, 40)
    codes = _compared(index, asked, probes or index.probes)
    exact = nearest(queries, index.vectors.select("doc_key", "v"), k).select("query_id", "doc_key")
    found = search(index, queries, k, probes, rerank).select("query_id", "doc_key")
    hit = exact.join(found, ["query_id", "doc_key"], "left_semi").agg(F.count("*").alias("hit"))
    every = exact.agg(F.count("*").alias("every"))
    counts = asked.agg(F.count("*").alias("n_queries"))
    one = counts.join(F.broadcast(codes)).join(F.broadcast(hit)).join(F.broadcast(every))  # one row each
    n = F.lit(index.n_rows)
    return one.select(
        n.alias("n_rows"), "n_queries", F.coalesce(F.try_divide("hit", "every"), F.lit(1.0)).alias("recall"),
        F.coalesce(F.try_divide("codes", n * F.col("n_queries")), F.lit(0.0)).alias("compared"),
        F.coalesce(F.try_divide(F.least(n, F.lit(wanted)).cast("double"), n), F.lit(0.0)).alias("scored"),
    )
