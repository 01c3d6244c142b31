"""Document fingerprints: MinHash signatures over word shingles in vectorised numpy, bands of them
joined in Spark, and Jaccard similarity verified on the shingles.

A signature holds, for each of `perms` universal hash functions x -> (a x + b) >> 32 of 64-bit
shingle hashes, 16 bits of the least value; likeness is the part of equal places.  A text without
words has the signature of all ones.  Nulls are empty texts; repeated rows and ties of doc_id are
separate documents, in the order of (doc_id, text); a null doc_id comes first.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm import words as W
from textloom.llm.graph import components
from textloom.llm.shared import cut, parts, prepare, text_key

PERMS, WORDS, BLOCK = 128, 5, 1 << 15


def coefficients(perms: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(seed))
    return rng.integers(0, 2**63, perms, dtype=np.uint64) * W.U(2) + W.U(1), rng.integers(0, 2**63, perms, dtype=np.uint64)


def signatures(x: np.ndarray, begin: np.ndarray, perms: int = PERMS) -> np.ndarray:
    """(texts, perms) uint16 from shingle hashes and each text's first shingle."""
    a, b = coefficients(perms)
    n = len(begin) - 1
    least = np.full((n, perms), 2**64 - 1, np.uint64)
    i, s = 0, 0
    h = np.empty(BLOCK, np.uint64)
    while i < n:  # from shingle s of text i on; a text with more than a block is met several times
        j = max(i + 1, int(np.searchsorted(begin, s + BLOCK, "right")) - 1)
        e = int(min(begin[j], s + BLOCK))
        some = np.flatnonzero(np.minimum(begin[i + 1 : j + 1], e) > np.maximum(begin[i:j], s)) + i
        if len(some):
            block, at, out = x[s:e], np.maximum(begin[some], s) - s, h[: e - s]
            with np.errstate(over="ignore"):
                for k in range(perms):
                    np.multiply(block, a[k], out=out)
                    np.add(out, b[k], out=out)
                    least[some, k] = np.minimum(least[some, k], np.minimum.reduceat(out, at))
        i, s = (j, e) if e == begin[j] else (j - 1, e)
    return (least >> W.U(32)).astype(np.uint16)


def of_texts(texts: pa.Array, k: int = WORDS, perms: int = PERMS) -> np.ndarray:
    data, offsets = W.buffers(texts)
    out = [np.empty((0, perms), np.uint16)]
    for a, b in W.slices(offsets):
        off = offsets[a : b + 1]
        out.append(signatures(*W.shingles(*W.words(data[off[0] : off[-1]], off - off[0]), k), perms))
    return np.concatenate(out)


def hexes(sig: np.ndarray) -> list[str]:
    raw, width = sig.astype(">u2").tobytes().hex(), sig.shape[1] * 4
    return [raw[i : i + width] for i in range(0, len(raw), width)]


# --- a document and the next one -------------------------------------------------------------


def _bucket_of(ids: np.ndarray, null: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.where(null, 0, np.searchsorted(bounds, ids.astype(np.float64), "left"))


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    null = column.is_null().to_numpy(zero_copy_only=False)
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), null


def beside_next(docs: DataFrame) -> DataFrame:
    """Rows (bucket, extra, doc_id, text) dealt by ranges of doc_id; each bucket ends with copies of
    the next bucket's first rows (extra), so that every row lies beside its successor.  One shuffle
    of the texts; the driver sees one doc_id for each bucket."""
    spark = docs.sparkSession
    prepare(spark)
    p = 4 * parts(spark)  # ranges, several for each partition
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    bounds = np.unique(docs.select(F.col("doc_id").cast("double").alias("d")).approxQuantile("d", [i / p for i in range(1, p)], 0.2 / p)) if p > 1 else np.empty(0)

    def heads(batches):
        for batch in batches:
            ids, null = _ids(batch.column(0))
            bucket = _bucket_of(ids, null, bounds)
            order = np.lexsort((ids, ~null, bucket))
            at = order[np.flatnonzero(np.diff(bucket[order], prepend=-1))]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[at].astype(np.int32)), pa.array(ids[at], mask=null[at])], ["bucket", "doc_id"])

    first = docs.select("doc_id").mapInArrow(heads, "bucket int, doc_id long").groupBy("bucket").agg(F.min("doc_id").alias("doc_id"), F.max(F.isnull("doc_id")).alias("null")).orderBy("bucket").collect()
    ends = [(r.bucket, None if r.null else r.doc_id) for r in first]
    before = {head: ends[i - 1][0] for i, (_, head) in enumerate(ends)}  # i = 0: the last bucket ends with the first row

    def deal(batches):
        for batch in batches:
            ids, null = _ids(batch.column(0))
            copies = [(i, before[v]) for i, v in ((i, None if null[i] else int(ids[i])) for i in np.flatnonzero(np.isin(ids, [h or 0 for h in before]))) if v in before]
            rows = np.concatenate([np.arange(len(ids)), np.array([i for i, _ in copies], np.int64)])
            bucket = np.concatenate([_bucket_of(ids, null, bounds), np.array([b for _, b in copies], np.int64)]).astype(np.int32)
            out = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(np.arange(len(rows)) >= len(ids)), *out.columns], ["bucket", "extra", "doc_id", "text"])

    return docs.mapInArrow(deal, "bucket int, extra boolean, doc_id long, text string").repartition(parts(spark), "bucket").sortWithinPartitions("bucket", "extra", "doc_id", "text")


def _edited(data: np.ndarray, offsets: np.ndarray):
    """For all rows but the last: code points, and the text with its last half replaced by the next row's first as many."""
    points = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(points, offsets)
    points = np.append(points, len(data))
    n = np.diff(first)
    half = n[:-1] // 2
    keep = points[first[:-2] + n[:-1] - half]
    take = points[first[1:-1] + np.minimum(half, n[1:])]
    raw = data.tobytes()
    return n[:-1], [raw[o:k] + raw[s:t] for o, k, s, t in zip(offsets[:-2], keep, offsets[1:-1], take, strict=True)]


def fingerprints(docs: DataFrame, k: int = WORDS, perms: int = PERMS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each row."""

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch])
            data, offsets = W.buffers(table.column("text"))
            for a, b in W.slices(offsets):
                b = min(b + 1, table.num_rows)
                if b - a >= 2:
                    yield some(table.slice(a, b - a).combine_chunks(), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            held = table.slice(table.num_rows - 1).combine_chunks().to_batches()[0]

    def some(table, data, offsets):
        chars, texts = _edited(data, offsets)
        sig = of_texts(table.column("text"), k, perms)
        edited = of_texts(pa.array(texts, pa.large_binary()), k, perms)
        keep = pa.array(~table.column("extra").to_numpy()[:-1])
        columns = [
            table.column("doc_id").combine_chunks().slice(0, len(texts)),
            pa.array(chars.astype(np.int64)),
            pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
            pa.array(hexes(sig[:-1])),
            pa.array(hexes(edited)),
            pa.array((sig[:-1] == edited).mean(1)),
            pa.array((sig[:-1] == sig[1:]).mean(1)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]).filter(keep)

    return beside_next(docs).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


# --- near duplicates -------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, threshold: float = 0.8, k: int = WORDS, bands: int = 25, rows: int = 5) -> DataFrame:
    """(doc_id, class_id): class_id is the least doc_id that verified links reach.

    Equal texts are one item.  Items that share a band are candidates: each is verified against
    the least item of its band's group; those that fail, against all of the group that these links
    don't reach yet.  So near copies of the least item cost pairs in proportion to their number, and
    no link between different classes is lost; a band of many texts below the threshold still costs
    all its pairs.  `bands` x `rows` places of the signature are used.  Only keys of bands are kept
    for all items; the texts of items that share one meet again for the verification.  Texts without
    words are alike; every row comes back, repeated ones too; a class of null ids alone has none.
    """
    spark = docs.sparkSession
    prepare(spark)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), F.xxhash64(*text_key(F.col("text"))).alias("item"))

    def sign(batches):
        for batch in batches:
            data, offsets = W.buffers(batch.column(1))
            for a, b in W.slices(offsets):
                off = offsets[a : b + 1]
                sig = signatures(*W.shingles(*W.words(data[off[0] : off[-1]], off - off[0]), k), bands * rows).reshape(b - a, bands, rows)
                key = [b"".join(hashlib.blake2b(bytes([i]) + s[i].tobytes(), digest_size=8).digest() for i in range(bands)) for s in sig]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(key, pa.binary())], ["item", "keys"])

    signed = base.select("item", "text").mapInArrow(sign, "item long, keys binary").groupBy("item").agg(F.max("keys").alias("keys"))
    items = cut(signed, "minhash")
    banded = items.select("item", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("i"), "keys").select("item", F.expr("substring(keys, 8 * i + 1, 8)").alias("key"))
    hubs = banded.groupBy("key").agg(F.min("item").alias("hub"), F.count("*").alias("n")).filter("n > 1").select("key", "hub")
    member = cut(banded.join(hubs, "key").filter("item <> hub"), "minhash-members")
    either = member.select("item").unionByName(member.select(F.col("hub").alias("item"))).distinct()
    texts = cut(base.select("item", "text").join(either, "item", "left_semi").groupBy("item").agg(F.max("text").alias("text")), "minhash-texts")
    stars = cut(_verified(member.select(F.col("item").alias("a"), F.col("hub").alias("b")).distinct(), texts, threshold, k), "minhash-links")
    reached = cut(components(stars).withColumnRenamed("node", "item"), "minhash-reached")
    placed = cut(member.join(reached, "item", "left").withColumn("component", F.coalesce("component", "item")), "minhash-placed")
    failed = placed.join(stars.select(F.col("a").alias("item"), F.col("b").alias("hub")), ["item", "hub"], "left_anti")
    rest = failed.select("key", F.col("item").alias("a"), F.col("component").alias("ca")).join(placed.select("key", F.col("item").alias("b"), F.col("component").alias("cb")), "key").filter("ca <> cb")
    rest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = stars.unionByName(_verified(rest, texts, threshold, k))
    found = components(links).withColumnRenamed("node", "item")
    ids = base.select("doc_id", "item").join(found, "item", "left").select("doc_id", F.coalesce("component", "item").alias("c"))
    return ids.join(ids.groupBy("c").agg(F.min("doc_id").alias("class_id")), "c").select("doc_id", "class_id")


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float, k: int) -> DataFrame:
    """The pairs (a, b) of items whose sets of shingles have Jaccard similarity of the threshold or more."""

    def sets(data, offsets):
        x, begin = W.shingles(*W.words(data[offsets[0] : offsets[-1]], offsets - offsets[0]), k)
        return [np.unique(x[s:e]) for s, e in zip(begin[:-1], begin[1:], strict=True)]

    def run(batches):
        for batch in batches:
            (one, at), (two, to) = (W.buffers(batch.column(i)) for i in (2, 3))
            for i, j in W.slices(at + to):
                ok = []
                for p, q in zip(sets(one, at[i : j + 1]), sets(two, to[i : j + 1]), strict=True):
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    ok.append(both >= threshold * (len(p) + len(q) - both))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    one = texts.select(F.col("item").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("item").alias("b"), F.col("text").alias("tb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def query(spark, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def classes(spark, sf_dir: str) -> DataFrame:
    """The second half of the method over the whole table: doc_id and its class's least doc_id."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
