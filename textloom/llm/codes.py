"""Vector code compression: a codebook for each part of the vectors, fitted by integer means.

Components become integers (floor of 256 x) and vectors are cut into equal consecutive parts.  A codebook
starts as that part of the first vectors in order of vec_id; each round assigns every part to its nearest
entry (squared Euclidean distance, ties to the lower index) and moves entries to the componentwise floor of
their parts' means.  Vectors are stored as columnar blocks, one array a component: a task adds distances up
component by component, adds its blocks' parts into int64 tensors of sums and counts with np.add.at, and
the tensors are merged by treeAggregate.  A tensor's size depends on the codebooks alone; nothing of the
rows reaches the driver but the first vectors (as many as entries).

Defined results: rows whose vector is null, empty or holds null or non-finite components go.  Vectors of
another length than the first one's (the least vec_id; null ids last, then by vector) have a null code and
error and no part in the codebooks; that length must be a multiple of the parts.  With fewer vectors than
entries a codebook has as many entries as there are vectors.  Repeated rows count as often as they stand
there.  Components from 2^16 on raise an error, as their sums would leave a long.  No rows give no rows.
Other columns don't pass through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.graph import hub_join
from textloom.llm.shared import cut, prepare, whole_matrix, whole_vector

BLOCK = 1024


def assign(columns: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(part, row) indices of the nearest entries and (row) errors of columnar vectors (component, row)."""
    parts, entries, width = books.shape
    n = columns.shape[1]
    codes, error = np.empty((parts, n), np.int64), np.zeros(n, np.int64)
    for p in range(parts):
        distance = np.zeros((n, entries), np.int64)
        for j in range(width):
            step = columns[p * width + j][:, None] - books[p, :, j]
            distance += step * step
        codes[p] = distance.argmin(1)  # the first of equal ones
        error += distance[np.arange(n), codes[p]]
    return codes, error


def _columns(dims: int):
    """Vectors of that length as columnar blocks of at most BLOCK rows."""

    def run(batches):
        for batch in batches:
            x = whole_matrix(batch.column(0))
            for i in range(0, len(x), BLOCK):
                yield pa.RecordBatch.from_arrays([pa.array([x[i : i + BLOCK].T.astype("<i4").tobytes()], pa.binary())], ["block"])

    return run


def _add(books: np.ndarray):
    parts, _, width = books.shape

    def run(total, block: bytes):
        sums, counts = total
        x = np.frombuffer(block, "<i4").reshape(parts * width, -1).astype(np.int64)
        codes, _ = assign(x, books)
        for p in range(parts):
            np.add.at(counts[p], codes[p], 1)
            for j in range(width):
                np.add.at(sums[p, :, j], codes[p], x[p * width + j])
        return sums, counts

    return run


def _merge(a, b):
    return a[0] + b[0], a[1] + b[1]


def fit(vectors: DataFrame, books: np.ndarray, rounds: int = 2) -> np.ndarray:
    """The codebooks (part, entry, component) after so many rounds over vectors (v: array<long> of one length)."""
    blocks = cut(vectors.select("v").mapInArrow(_columns(books.shape[0] * books.shape[2]), "block binary"), "vector-columns")
    for _ in range(rounds):
        zero = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
        sums, counts = blocks.rdd.map(lambda r: bytes(r.block)).treeAggregate(zero, _add(books), _merge)
        books = np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], books)
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _encode(books: np.ndarray):
    dims = books.shape[0] * books.shape[2]

    def run(batches):
        for batch in batches:
            rows = batch.column("v")
            fit_ = np.flatnonzero(rows.value_lengths().to_numpy(zero_copy_only=False) == dims)
            x = whole_matrix(rows.take(pa.array(fit_)))
            code, error = np.full(batch.num_rows, None, object), np.full(batch.num_rows, None, object)
            for i in range(0, len(fit_), BLOCK):
                c, e = assign(x[i : i + BLOCK].T, books)
                text, step = c.T.astype(np.uint8).tobytes().hex(), 2 * len(books)
                code[fit_[i : i + BLOCK]] = [text[k : k + step] for k in range(0, len(text), step)]
                error[fit_[i : i + BLOCK]] = e.tolist()
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    return run


def codebooks(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> np.ndarray | None:
    """Fitted codebooks of rows (vec_id, v); None without rows."""
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries, two hexadecimal digits each")
    order = F.col("vec_id").asc_nulls_last(), "v"
    first = [r.v for r in vectors.orderBy(*order).select("v").limit(entries).collect()]
    if not first:
        return None
    dims = len(first[0])
    if dims % parts:
        raise ValueError(f"vectors of {dims} components can't be cut into {parts} equal parts")
    same = vectors.filter(F.size("v") == dims)
    if any(len(v) != dims for v in first):
        first = [r.v for r in same.orderBy(*order).select("v").limit(entries).collect()]
    start = np.array(first, np.int64).reshape(len(first), parts, dims // parts).transpose(1, 0, 2)
    return fit(same, np.ascontiguousarray(start), rounds)


def compress(rows: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> DataFrame:
    """vec_id, label, code (two hexadecimal digits a part), error, label_error (summed over equal labels, nulls
    together) and codebooks_sha256 of rows (vec_id, embedding, label)."""
    prepare(rows.sparkSession)
    vectors = rows.select("vec_id", "label", whole_vector(F.col("embedding")).alias("v")).filter("v is not null")
    books = codebooks(vectors.select("vec_id", "v"), parts, entries, rounds)
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    if books is None:
        return vectors.select("vec_id", "label", *(F.lit(None).cast(t).alias(c) for c, t in (("code", "string"), ("error", "long"), ("label_error", "long"), ("codebooks_sha256", "string"))))
    coded = cut(vectors.mapInArrow(_encode(books), f"{kinds}, code string, error long"), "vector-codes")
    coded = coded.withColumn("__label", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")))
    sums = coded.groupBy("__label").agg(F.sum("error").alias("label_error"))
    spread = hub_join(coded.withColumn("__by", F.xxhash64("vec_id", "code")), sums, "__label", "__by")
    return spread.select("vec_id", "label", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).drop("label")


def _round(n: int) -> str:
    """SQL: codebook b{n} from b{n-1} (part, entry, c: components)."""
    return f"""
a{n} AS (SELECT part, arg_min(entry, (d, entry)) AS entry, any_value(x) AS x FROM (
  SELECT p.vec_id, p.part, b.entry, p.x, list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - b.c[i]) * (p.x[i] - b.c[i]))) AS d FROM p JOIN b{n - 1} b USING (part)) GROUP BY vec_id, part),
m{n} AS (SELECT part, entry, list(m ORDER BY i) AS c FROM (SELECT part, entry, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS m FROM a{n}, (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM p))) AS i) GROUP BY part, entry, i) GROUP BY part, entry),
b{n} AS (SELECT part, entry, coalesce(m.c, b.c) AS c FROM b{n - 1} b LEFT JOIN m{n} m USING (part, entry))"""


#: The same for tables of distinct vec_ids and vectors of one length.
SQL = f"""WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT vec_id, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS x FROM v, (SELECT unnest(range(16)) AS part)),
b0 AS (SELECT part, dense_rank() OVER (ORDER BY vec_id) - 1 AS entry, x AS c FROM p WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT 64)),
{_round(1)}, {_round(2)},
e AS (SELECT vec_id, part, min(d) AS d, arg_min(entry, (d, entry)) AS entry FROM (
  SELECT p.vec_id, p.part, b.entry, list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - b.c[i]) * (p.x[i] - b.c[i]))) AS d FROM p JOIN b2 b USING (part)) GROUP BY vec_id, part),
o AS (SELECT vec_id, string_agg(lower(printf('%02x', CAST(entry AS INTEGER))), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM e GROUP BY vec_id),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM o JOIN v USING (vec_id), h"""
