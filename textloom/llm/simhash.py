"""SimHash near-dedup by a segment-popcount embedding.

Fingerprint: XXH64 (seed 42) of each shingle of `k` lower-cased words, joined by spaces; a bit is 1
if it is set in over half of them.  No words: fingerprint zero, linked like any other.

Links (at most `radius` = 4 differing bits): a fingerprint is embedded as the bit counts of its 32
two-bit segments.  The Manhattan distance of two embeddings is at most their Hamming distance, so
one half of 16 segments is within 2, and some grid point lies within 1 of both there.  Each
fingerprint enters the cells of its own half-vectors and of all their neighbours at distance 1;
pairs that share a cell are candidates, verified on all 64 bits.  Large cells are divided again, by the
cells of the quarters of the other half, one of which is within 2 as well.  A cell gives a spanning
forest of its links, never all its pairs.

Nulls are empty texts; equal texts are one fingerprint; a null doc_id can be nobody's component_id
unless the whole component has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.graph import components, hub_join
from textloom.llm.shared import cut, parts, prepare, text_key

RADIUS, LARGE = 4, 256


def fingerprint(text: bytes, k: int) -> int:
    """The fingerprint of a UTF-8 text."""
    import xxhash

    joined = b" ".join(text.lower().split())  # both ASCII only for bytes: A-Z, and space and \t..\r
    if not joined:
        return 0
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = np.concatenate([[0], gaps + 1]), np.append(gaps, len(joined))
    k = min(k, len(starts))
    starts, ends = starts[: len(starts) - k + 1], ends[k - 1 :]
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(starts), 1 << 15):
        h = np.array([digest(joined[s:e], 42) for s, e in zip(starts[i : i + (1 << 15)].tolist(), ends[i : i + (1 << 15)].tolist(), strict=True)], np.uint64)
        total += np.unpackbits(h.astype(">u8").view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, k: int = 4, text: str = "text") -> DataFrame:
    """docs with a column fingerprint (long: its 64 bits) in place of the text."""
    prepare(docs.sparkSession)
    kept = [c for c in docs.columns if c != text]

    def run(batches):
        for batch in batches:
            f = [fingerprint((t or "").encode(), k) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(np.array(f, np.uint64).view(np.int64))], [*kept, "fingerprint"])

    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept] + ["fingerprint long"])
    return docs.select(F.col(text).cast("string").alias(text), *kept).mapInArrow(run, schema)


def _counts(f: np.ndarray) -> np.ndarray:
    """Bit counts of two-bit segments."""
    return f - ((f >> np.uint64(1)) & np.uint64(0x5555555555555555))


def _around(v: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The points v of that many segments and all their neighbours at distance 1, and the index of the point of each."""
    out, who = [v], [np.arange(len(v))]
    for i in range(segments):
        one = np.uint64(1 << (2 * i))
        count = (v >> np.uint64(2 * i)) & np.uint64(3)
        for ok, moved in ((count < 2, v + one), (count > 0, v - one)):
            at = np.flatnonzero(ok)
            out.append(moved[at])
            who.append(at)
    return np.concatenate(out), np.concatenate(who)


def cells(f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The grid cells of fingerprints (uint64), and the index of the fingerprint of each."""
    counts = _counts(f)
    found = [_around((counts >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF), 16) for half in (0, 1)]
    return np.concatenate([v | np.uint64(half << 32) for half, (v, _) in enumerate(found)]), np.concatenate([who for _, who in found])


def _divided(f: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """The same by the quarters of the half that a cell doesn't stand for."""
    other = _counts(f) >> np.uint64(32 * (1 - half))
    found = [_around((other >> np.uint64(16 * quarter)) & np.uint64(0xFFFF), 8) for quarter in (0, 1)]
    return np.concatenate([v | np.uint64(quarter << 16) for quarter, (v, _) in enumerate(found)]), np.concatenate([who for _, who in found])


def _embed(batches):
    for batch in batches:
        f = batch.column(0).to_numpy().view(np.uint64)
        cell, who = cells(f)
        yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), pa.array(f[who].view(np.int64))], ["cell", "f"])


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[list, list]:
    """A spanning forest of links: (node, root)."""
    parent: dict[int, int] = {}

    def root(x):
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    moved = [(x, root(x)) for x in parent if parent[x] != x]
    return [x for x, _ in moved], [r for _, r in moved]


def _group(f: np.ndarray, radius: int):
    """Links of one large cell: each search takes what it reaches out of the rest."""
    rest = f
    while len(rest) > 1:
        todo, rest, root = [rest[0]], rest[1:], rest[0]
        while todo and len(rest):
            near = np.bitwise_count(rest ^ todo.pop()) <= radius
            if near.any():
                found = rest[near]
                rest = rest[~near]
                todo.extend(found)
                yield found, np.full(len(found), root)


def _pairs(cell: np.ndarray, f: np.ndarray, radius: int, divide: bool = True):
    """Links within cells (rows in any order, repeats allowed): all of small cells, enough to join those of large ones."""
    order = np.lexsort((f, cell))
    cell, f = cell[order], f[order]
    new = np.ones(len(f), bool)
    new[1:] = (cell[1:] != cell[:-1]) | (f[1:] != f[:-1])
    cell, f = cell[new], f[new]
    edge = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1], [True]]))
    size = np.diff(edge)
    for g in np.flatnonzero(size > LARGE):
        part = f[edge[g] : edge[g + 1]]
        if divide:
            sub, who = _divided(part, int(cell[edge[g]]) >> 32)
            yield from _pairs(sub, part[who], radius, False)
        else:
            yield from _group(part, radius)
    last = np.repeat(edge[1:], size)
    at = np.flatnonzero(np.repeat(size <= LARGE, size))
    lag = 1
    while len(at := at[at + lag < last[at]]):
        near = at[np.bitwise_count(f[at] ^ f[at + lag]) <= radius]
        yield f[near], f[near + lag]
        lag += 1


def links(cell: np.ndarray, f: np.ndarray, radius: int) -> tuple[list, list]:
    """A spanning forest of the verified links within cells."""
    none = np.empty(0, np.uint64)
    return _forest(*(np.concatenate(x) for x in zip((none, none), *_pairs(cell, f, radius), strict=True)))


def _link(radius: int):
    def run(batches):
        got = [(b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64)) for b in batches]
        if got:
            x, root = links(*map(np.concatenate, zip(*got, strict=True)), radius)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(v, np.uint64).view(np.int64)) for v in (x, root)], ["a", "b"])

    return run


def near(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(node, component) of the distinct fingerprints (one long column) that any link joins."""
    if not 0 <= radius <= RADIUS:
        raise ValueError("the cells find all links of radius 0 to 4")
    spark = distinct.sparkSession
    prepare(spark)
    # dealt anew: the few bytes of a fingerprint become dozens of rows
    pairs = distinct.repartition(4 * parts(spark), *distinct.columns).mapInArrow(_embed, "cell long, f long").repartition(4 * parts(spark), "cell").mapInArrow(_link(radius), "a long, b long")
    return components(pairs)


def near_duplicates(docs: DataFrame, k: int = 4, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (long) and component_id (least doc_id reachable) of each row."""
    own = cut(fingerprints(docs.select("doc_id", "text"), k), "simhash")
    first = own.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    found = near(first.select("fingerprint"), radius).withColumnRenamed("node", "fingerprint")
    first = first.join(found, "fingerprint", "left").select("fingerprint", "first", F.coalesce("component", "fingerprint").alias("component"))
    least = first.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = hub_join(first, least, "component", "fingerprint").select("fingerprint", "component_id")
    return own.join(classes, "fingerprint").select("doc_id", "fingerprint", "component_id")


def representatives(docs: DataFrame, k: int = 4, radius: int = RADIUS) -> DataFrame:
    """doc_id, k1, k2 (text_key) of one row of each class: the least doc_id (null last), then the least text key."""
    own = cut(fingerprints(docs.select("doc_id", *text_key(F.col("text")), "text"), k), "simhash")
    least = F.min(F.struct(F.isnull("doc_id").alias("missing"), "doc_id", "k1", "k2"))
    first = own.groupBy("fingerprint").agg(least.alias("first"))
    found = near(first.select("fingerprint"), radius).withColumnRenamed("node", "fingerprint")
    first = first.join(found, "fingerprint", "left").select("first", F.coalesce("component", "fingerprint").alias("component"))
    return first.groupBy("component").agg(F.min("first").alias("first")).select("first.doc_id", "first.k1", "first.k2")


def hex64(c):
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", hex64(F.col("fingerprint")).alias("fingerprint"), "component_id")
