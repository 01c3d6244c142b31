"""Embedding near-dedup by an epsilon grid order join.

Cosine >= c of unit vectors is a distance of at most eps = sqrt(2 - 2c), and projections are no
farther apart than vectors.  Vectors are sorted by label and by their cells (width eps) on the
leading principal directions and cut into blocks.  Blocks meet by their cells on the first two
directions, if their intervals on all of them may come within eps; such pairs are dealt by groups of
consecutive blocks, so that a block is sent once for a pair of groups.  Two blocks are joined
recursively: sequences split in halves, halves that are provably distant are skipped, leaves are
compared in double precision.  Embeddings of doubles stay doubles.

A vector that is null, zero, or holds null or non-finite components links with nothing, nor does
one without a label; vectors of other lengths never meet.  Equal vectors of a label (by 128 bits of
hashes) are one item with a count.  A block pair gives counts and a spanning forest, never its pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.graph import components, hub_join
from textloom.llm.shared import cut, parts, prepare

DIRECTIONS, BLOCK, LEAF, GROUP = 4, 1024, 64, 8
SLACK = 1e-9


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows as unit vectors in double precision; shorter ones are filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), size.max(initial=0)))
    out[np.arange(out.shape[1]) < size[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return _unit(out) if len(size) else out


def _moments(batches):
    total = None
    for batch in batches:
        x = _matrix(batch.column(0))
        m = np.hstack([np.full((1, 1), len(x)), x.sum(0, keepdims=True)]).ravel(), x.T @ x
        if total is None or len(total[1]) < len(m[1]):
            m, total = total, m
        if m is not None:
            n = len(m[1])
            total[0][: n + 1] += m[0]
            total[1][:n, :n] += m[1]
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([t.tobytes()], pa.binary()) for t in total], ["s", "m"])


def _merge(batches):
    total = None
    for batch in batches:
        for s, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            s = np.frombuffer(s).copy()
            got = s, np.frombuffer(m).reshape(len(s) - 1, -1).copy()
            if total is None or len(total[1]) < len(got[1]):
                got, total = total, got
            if got is not None:
                n = len(got[1])
                total[0][: n + 1] += got[0]
                total[1][:n, :n] += got[1]
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([t.tobytes()], pa.binary()) for t in total], ["s", "m"])


def directions(items: DataFrame, q: int = DIRECTIONS) -> np.ndarray:
    """The leading principal directions (length, q); second moments are summed by the executors."""
    got = next(_merge(r for r in items.select("v").mapInArrow(_moments, "s binary, m binary").repartition(8).mapInArrow(_merge, "s binary, m binary").toArrow().to_batches()), None)
    if got is None:
        return np.zeros((0, q))
    s = np.frombuffer(got.column(0)[0].as_py())
    mean = s[1:] / s[0]
    cov = np.frombuffer(got.column(1)[0].as_py()).reshape(len(mean), -1) / s[0] - np.outer(mean, mean)
    vectors = np.linalg.eigh(cov)[1][:, ::-1][:, :q]
    return np.pad(vectors, ((0, 0), (0, q - vectors.shape[1])))


def _project(axes: np.ndarray, eps: float):
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("v"))
            p = x @ axes[: x.shape[1]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(np.floor(p[:, i] / eps).astype(np.int32)) for i in range(p.shape[1]))], [*batch.schema.names, *(f"g{i}" for i in range(p.shape[1]))])

    return run


def _blocks(axes: np.ndarray, size: int, dtype: str):
    """Consecutive items of one label and length, at most `size`, as one row."""

    def pack(table):
        x = _matrix(table.column("v"))
        p = x @ axes[: x.shape[1]]
        v = pa.array([np.asarray(table.column("v").combine_chunks().flatten(), dtype).tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([table.column("label")[0].as_py()], pa.int64()), pa.array([x.shape[1]], pa.int32()), pa.array([table.column("item")[0].as_py()], pa.int64()), pa.array([p.min(0).tolist()], pa.list_(pa.float64())), pa.array([p.max(0).tolist()], pa.list_(pa.float64())), pa.array([np.asarray(table.column("item"), np.int64).tobytes()], pa.binary()), pa.array([np.asarray(table.column("n"), np.int64).tobytes()], pa.binary()), v],
            ["label", "len", "block", "lo", "hi", "items", "counts", "vectors"],
        )

    def run(batches):
        held = None
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            while held.num_rows:
                label, length = np.asarray(held.column("label")), np.asarray(held.column("len"))
                other = np.flatnonzero((label != label[0]) | (length != length[0]))
                end = min(int(other[0]) if len(other) else held.num_rows, size)
                if end == held.num_rows and end < size:
                    break
                yield pack(held.slice(0, end))
                held = held.slice(end)
        if held is not None and held.num_rows:
            yield pack(held)

    return run


def _join(a: np.ndarray, b: np.ndarray, pa_: np.ndarray, pb: np.ndarray, ia: np.ndarray, ib: np.ndarray, eps: float, least: float, same: bool):
    """Links between two sequences (index pairs), halves first; same: both are one sequence."""
    if not len(ia) or not len(ib) or (not same and ((pa_[ia].min(0) - pb[ib].max(0) > eps) | (pb[ib].min(0) - pa_[ia].max(0) > eps)).any()):
        return
    if len(ia) <= LEAF and len(ib) <= LEAF:
        i, j = np.nonzero(a[ia] @ b[ib].T >= least)
        if same:
            i, j = i[i < j], j[i < j]
        if len(i):
            yield ia[i], ib[j]
        return
    ha, hb = np.array_split(ia, 2 if len(ia) > 1 else 1), np.array_split(ib, 2 if len(ib) > 1 else 1)
    for m, x in enumerate(ha):
        for n, y in enumerate(hb):
            if not same or m <= n:
                yield from _join(a, b, pa_, pb, x, y, eps, least, same and m == n)


def _pair(a: dict, b: dict, same: bool, eps: float, least: float):
    """For a pair of blocks: (item, root, links to add to it) of a spanning forest of the links."""
    links = [np.zeros(len(x["items"]), np.int64) for x in (a, b)]
    label = [np.arange(len(links[0])), np.arange(len(links[0]), len(links[0]) + len(links[1]))]
    if same:
        label[1] = label[0]
    parent = np.arange(len(links[0]) + len(links[1]))
    for i, j in _join(a["x"], b["x"], a["p"], b["p"], *(np.arange(len(v)) for v in links), eps, least, same):
        np.add.at(links[0], i, b["counts"][j])
        np.add.at(links[0 if same else 1], j, a["counts"][i])
        s, t = label[0][i], label[1][j]
        while True:  # the least root of both ends, until all links are within a tree
            u, v = parent[s], parent[t]
            if (u == v).all():
                break
            np.minimum.at(parent, np.maximum(u, v), np.minimum(u, v))
            while (parent[parent] != parent).any():
                parent = parent[parent]
    name = np.concatenate([a["items"], b["items"]])
    for side, x in ((0, a),) if same else ((0, a), (1, b)):
        at = np.flatnonzero(links[side])
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(x["items"][at]), pa.array(name[parent[label[side][at]]]), pa.array(links[side][at])], ["item", "root", "links"])


def _compare(axes: np.ndarray, eps: float, least: float, dtype: str):
    """From rows sorted by (ga, gb), a pair of groups: first its blocks, then its pairs of blocks (a, b)."""

    def block(r: dict) -> dict:
        x = _unit(np.frombuffer(r["vectors"], dtype).astype(np.float64).reshape(-1, r["len"]))
        return {"items": np.frombuffer(r["items"], np.int64), "counts": np.frombuffer(r["counts"], np.int64), "x": x, "p": x @ axes[: x.shape[1]]}

    def run(batches):
        now, held = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if (r["ga"], r["gb"]) != now:
                    now, held = (r["ga"], r["gb"]), {}
                if r["vectors"] is not None:
                    held[r["a"]] = block(r)
                else:
                    yield from _pair(held[r["a"]], held[r["b"]], r["a"] == r["b"], eps, least)

    return run


def near_duplicates(rows: DataFrame, cosine: float = 0.98, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row (vec_id, embedding, label)."""
    if not 0 < cosine <= 1:
        raise ValueError("cosine is in (0, 1]")
    spark = rows.sparkSession
    prepare(spark)
    p, eps, least = parts(spark), math.sqrt(2 - 2 * cosine) + SLACK, cosine
    kind = "array<float>" if rows.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    dtype = "<f4" if kind == "array<float>" else "<f8"
    e = F.col("embedding").cast(kind)
    fine = (F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    ok = F.coalesce(F.col("label").isNotNull() & fine, F.lit(False))
    keys = [F.when(ok, F.xxhash64(F.lit(i), "label", e)).alias(k) for i, k in enumerate(("k1", "k2"))]
    own = rows.select(F.col("vec_id").cast("long"), e.alias("v"), F.col("label").cast("long").alias("label"), *keys)
    items = own.filter("k1 is not null").groupBy("k1", "k2").agg(F.first("v").alias("v"), F.first("label").alias("label"), F.count("*").alias("n"), F.min("vec_id").alias("first"))
    items = cut(items.withColumn("item", F.monotonically_increasing_id()).withColumn("len", F.size("v")), "vectors")
    axes = directions(items)
    g = [f"g{i}" for i in range(DIRECTIONS)]
    ordered = (
        items.select("label", "len", "item", "n", "v")
        .mapInArrow(_project(axes, eps), f"label long, len int, item long, n long, v {kind}, " + ", ".join(f"{c} int" for c in g))
        .repartitionByRange(max(1, p), "label", "len", *g, "item")
        .sortWithinPartitions("label", "len", *g, "item")
    )
    blocks = ordered.select("label", "len", "item", "n", "v").mapInArrow(_blocks(axes, block, dtype), "label long, len int, block long, lo array<double>, hi array<double>, items binary, counts binary, vectors binary")
    blocks = cut(blocks.withColumn("seq", F.floor(F.monotonically_increasing_id() / GROUP)), "vector-blocks")  # consecutive blocks share a group

    def cells(more: int) -> DataFrame:
        """Blocks by the cells of their intervals on two directions, and `more` around."""
        one = lambda i: F.explode(F.sequence(F.floor(F.col("lo")[i] / eps) - more, F.floor(F.col("hi")[i] / eps) + more))
        return blocks.select("label", "len", "block", "seq", "lo", "hi", one(0).alias("c0")).select("*", one(1).alias("c1"))

    x, y = cells(0).alias("x"), cells(1).alias("y")
    at = F.col("x.block") <= F.col("y.block")
    for c in ("label", "len", "c0", "c1"):
        at &= F.col(f"x.{c}") == F.col(f"y.{c}")
    for i in range(DIRECTIONS):
        at &= (F.col("x.lo")[i] - F.col("y.hi")[i] <= eps) & (F.col("y.lo")[i] - F.col("x.hi")[i] <= eps)
    near = x.join(y, at).select(F.col("x.block").alias("a"), F.col("y.block").alias("b"), F.col("x.seq").alias("s"), F.col("y.seq").alias("t")).distinct()
    near = cut(near.select("a", "b", F.least("s", "t").alias("ga"), F.greatest("s", "t").alias("gb")), "vector-pairs")
    sent = near.select("ga", "gb", F.explode(F.array("a", "b")).alias("a")).distinct()
    sent = sent.join(blocks.select(F.col("block").alias("a"), "len", "items", "counts", "vectors"), "a").select("ga", "gb", "a", F.lit(None).cast("long").alias("b"), "len", "items", "counts", "vectors")
    told = near.select("ga", "gb", "a", "b", *(F.lit(None).cast(t).alias(c) for c, t in (("len", "int"), ("items", "binary"), ("counts", "binary"), ("vectors", "binary"))))
    dealt = sent.unionByName(told).repartition(4 * p, "ga", "gb").sortWithinPartitions("ga", "gb", F.col("b").asc_nulls_first(), "a")
    found = cut(dealt.mapInArrow(_compare(axes, eps, least, dtype), "item long, root long, links long"), "vector-links")
    comps = components(found.select(F.col("item").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "item")
    sums = found.groupBy("item").agg(F.sum("links").alias("links"))
    classes = items.select("k1", "k2", "item", "n", "first").join(sums, "item", "left").join(comps, "item", "left").withColumn("component", F.coalesce("component", "item"))
    ids = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = hub_join(classes, ids, "component", "item").select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = own.select("vec_id", "k1", "k2").join(classes, ["k1", "k2"], "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"), F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
