"""LM scoring: an interpolated modified Kneser-Ney bigram model, counted in Spark, kept as sorted
hash arrays in the shared folder and memory-mapped by the workers that score.

Three passes over the texts: word counts -> vocabulary; pair counts -> model; scores.  Each pass
counts within its task first and ships packed arrays, dealt by hash ranges, so a frequent word is
one entry of one array, never a group.  Every task of a reduction holds about 1/partitions of the
distinct words or pairs.  A document is one sentence: START w1 .. wn END.

Definitions (D are the discounts of Chen and Goodman, from the counts of counts):
  p(w|u) = max(c(uw)-D(c(uw)),0)/c(u) + g(u) p1(w)
  p1(w)  = max(a(w)-D'(a(w)),0)/A + g' / (V+1),   a(w) = distinct words before w, A their sum
An unseen u backs off to p1; V distinct training tokens and one class for unknown words.

Nulls and empty texts are documents of the END token alone.  Repeated rows count each time.
More than 2^32 - 2 distinct words raise ValueError.  An empty training set gives the uniform model 1/(V+1) with V = 0.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm import words as W
from textloom.llm.shared import cut, map_array, parts, prepare, shared_dir, write_arrays

END = np.uint64(0xE2D5A9C3B1F70001)
FLUSH = 1 << 20


def _bits(n: int) -> int:
    return max(1, (n - 1).bit_length())


def _shards(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def _tokens(texts: pa.Array):
    """For slices of a batch: hashes of words and ENDs in order, and each text's first token."""
    data, offsets = W.buffers(texts)
    for a, b in W.slices(offsets):
        off = offsets[a : b + 1]
        h, first = W.words(data[off[0] : off[-1]], off - off[0])
        begin = first + np.arange(len(first))
        out = np.full(begin[-1], END, W.U)
        out[np.arange(len(h)) + np.repeat(np.arange(b - a), np.diff(first))] = h
        yield out, begin


class _Running:
    """Counts by key, folded together now and then so memory follows the distinct keys."""

    def __init__(self, dtype):
        self.parts, self.n, self.last = [], 0, 0
        self.none = (np.empty(0, dtype), np.empty(0, np.int64))

    def add(self, keys, counts):
        self.parts.append((keys, counts))
        self.n += len(keys)
        if self.n > FLUSH and self.n > 2 * self.last:
            self.parts = [self.sum()]
            self.n = self.last = len(self.parts[0][0])

    def sum(self):
        return W.tally(*map(np.concatenate, zip(*self.parts, strict=True))) if self.parts else self.none


def _deal(shard: np.ndarray, bits: int):
    """Ranges of an array sorted by shard."""
    cuts = np.searchsorted(shard, np.arange((1 << bits) + 1))
    return ((s, int(cuts[s]), int(cuts[s + 1])) for s in range(1 << bits) if cuts[s] < cuts[s + 1])


def _count_words(bits: int):
    def run(batches):
        run = _Running(W.U)
        for batch in batches:
            for tokens, _ in _tokens(batch.column(0)):
                run.add(*W.tally(tokens))
        keys, counts = run.sum()
        for s, a, b in _deal(_shards(keys, bits), bits):
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([W.planes(keys[a:b])], pa.binary()), pa.array([W.planes(counts[a:b])], pa.binary())], ["shard", "keys", "counts"])

    return run


def _gather(batches, dtype):
    """The blobs of a partition by shard."""
    held: dict[int, list] = {}
    for batch in batches:
        for s, k, c in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            held.setdefault(s, []).append((k, c))
    while held:
        s, blobs = held.popitem()
        yield s, *W.tally(*map(np.concatenate, zip(*((W.unplanes(k, dtype), W.unplanes(c, np.int64)) for k, c in blobs), strict=True)))


def _write_words(path: str):
    def run(batches):
        for s, keys, counts in _gather(batches, W.U):
            write_arrays(f"{path}/words/{s:06d}", {"keys": keys, "counts": counts})
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([len(keys)], pa.int64()), pa.array([int(counts.sum())], pa.int64())], ["shard", "n", "total"])

    return run


class Sharded:
    """Sorted 64-bit keys in shards by their top bits, and arrays beside them."""

    def __init__(self, path: str, bits: int, starts: np.ndarray, beside: dict[str, str]):
        self.bits, self.starts, self.path, self.beside = bits, starts, path, beside
        self._open: dict[int, tuple] = {}

    def _shard(self, s: int):
        if s not in self._open:
            self._open[s] = tuple(map_array(f"{self.path}/{s:06d}/{k}", t) for k, t in {"keys": "u8", **self.beside}.items())
        return self._open[s]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For sorted distinct keys: their global index (-1: absent) and the first array's value (0: absent)."""
        index, value = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        for s, a, b in _deal(_shards(keys, self.bits), self.bits):
            if self.starts[s] == self.starts[s + 1]:
                continue
            held, beside = self._shard(s)[:2]
            at = np.minimum(np.searchsorted(held, keys[a:b]), len(held) - 1)
            hit = held[at] == keys[a:b]
            index[a:b] = np.where(hit, at + self.starts[s], -1)
            value[a:b] = np.where(hit, beside[at], 0)
        return index, value


@lru_cache(maxsize=2)
def _vocabulary(path: str, bits: int, sizes: bytes) -> Sharded:
    return Sharded(f"{path}/words", bits, np.frombuffer(sizes, np.int64), {"counts": "i8"})


def _ids(tokens: np.ndarray, vocabulary: Sharded, unknown: int):
    """Vocabulary ids and counts of tokens."""
    keys, inverse = np.unique(tokens, return_inverse=True)
    index, count = vocabulary.find(keys)
    return np.where(index < 0, unknown, index)[inverse], count[inverse]


def _pairs(ids: np.ndarray, begin: np.ndarray, start: int) -> np.ndarray:
    """previous id << 32 | id, for each token."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[begin[:-1]] = start
    return before.astype(W.U) << np.uint64(32) | ids.astype(W.U)


def _count_pairs(path: str, vbits: int, sizes: bytes, bits: int):
    def run(batches):
        vocabulary = _vocabulary(path, vbits, sizes)
        n = int(vocabulary.starts[-1])
        run = _Running(W.U)
        for batch in batches:
            for tokens, begin in _tokens(batch.column(0)):
                run.add(*W.tally(_pairs(_ids(tokens, vocabulary, n + 1)[0], begin, n)))
        keys, counts = run.sum()
        shard = _shards(W.mix(keys), bits)
        order = np.argsort(shard, kind="stable")
        keys, counts = keys[order], counts[order]
        for s, a, b in _deal(shard[order], bits):
            u, w = (keys[a:b] >> np.uint64(32)).astype(np.uint32), keys[a:b].astype(np.uint32)
            u[1:] = np.diff(u)
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([W.planes(u)], pa.binary()), pa.array([W.planes(w)], pa.binary()), pa.array([W.planes(counts[a:b])], pa.binary())], ["shard", "u", "w", "counts"])

    return run


def _write_pairs(path: str, step: int):
    """Writes the pairs of each shard; gives, for ranges of ids, what the pairs say of them: kind 0 of contexts (pairs of count 1, 2, more), 1 of words (pairs)."""

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for s, u, w, c in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                key = np.cumsum(W.unplanes(u, np.uint32), dtype=np.uint32).astype(W.U) << np.uint64(32) | W.unplanes(w, np.uint32).astype(W.U)
                held.setdefault(s, []).append((key, W.unplanes(c, np.int64)))
        while held:
            s, blobs = held.popitem()
            keys, counts = W.tally(*map(np.concatenate, zip(*blobs, strict=True)))
            mixed = W.mix(keys)
            order = np.argsort(mixed)
            write_arrays(f"{path}/pairs/{s:06d}", {"keys": mixed[order], "counts": counts[order]})
            yield _row(-1, s, np.array([len(keys)]), *(np.array([int((counts == k).sum())]) for k in (1, 2, 3, 4)))
            u, w = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
            at = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
            few = [np.add.reduceat(x.astype(np.int64), at) for x in (counts == 1, counts == 2, counts > 2)]
            yield from _by_range(0, u[at], few, step)
            w, n = W.tally(w)
            yield from _by_range(1, w, [n], step)

    return run


def _row(kind: int, key: int, *arrays):
    arrays = [*(W.planes(np.asarray(a, np.int64)) for a in arrays), b"", b"", b"", b"", b""][:5]
    return pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([key], pa.int64()), *(pa.array([a], pa.binary()) for a in arrays)], ["kind", "key", *"abcde"])


def _by_range(kind: int, ids: np.ndarray, values: list, step: int):
    for r in range(int(ids[0]) // step, int(ids[-1]) // step + 1) if len(ids) else ():
        a, b = np.searchsorted(ids, [r * step, (r + 1) * step])
        if a < b:
            yield _row(kind, r, ids[a:b] - r * step, *(v[a:b] for v in values))


def _write_stats(path: str, step: int):
    """Dense arrays for each range of ids: contexts' pairs of count 1, 2 and more, and a(w)."""

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for kind, key, *blobs in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                table = held.setdefault(key, np.zeros((4, step), np.uint32))
                ids, *values = (W.unplanes(b, np.int64) for b in blobs)
                for row, v in zip((3,) if kind else (0, 1, 2), values, strict=False):
                    table[row, ids] += v.astype(np.uint32)
        for r, table in held.items():
            write_arrays(f"{path}/stats/{r:06d}", {"all": table})
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), *(pa.array([int((table[3] == k).sum())], pa.int64()) for k in (1, 2, 3, 4))], ["range", "n1", "n2", "n3", "n4"])

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """D1, D2, D3+ from the counts of counts; where these can't give them (too few, or not within 0..k), 0.5, 1.0, 1.5."""
    if min(n1, n2, n3, n4) > 0:
        y = n1 / (n1 + 2 * n2)
        d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        if all(0 < x < k for k, x in enumerate(d, 1)):
            return d
    return [0.5, 1.0, 1.5]


class Model:
    """The memory-mapped model."""

    def __init__(self, spec: dict):
        self.spec = spec
        self.vocabulary = Sharded(f"{spec['path']}/words", spec["vbits"], np.frombuffer(spec["vstarts"], np.int64), {"counts": "i8"})
        self.pairs = Sharded(f"{spec['path']}/pairs", spec["pbits"], np.frombuffer(spec["pstarts"], np.int64), {"counts": "i8"})
        self._stats: dict[int, np.ndarray] = {}

    def stats(self, ids: np.ndarray) -> np.ndarray:
        """The four statistics of sorted ids."""
        step, out = self.spec["step"], np.zeros((4, len(ids)), np.int64)
        for r in np.unique(ids // step):
            if int(r) not in self._stats:
                self._stats[int(r)] = map_array(f"{self.spec['path']}/stats/{int(r):06d}/all", "u4").reshape(4, step) if int(r) in self.spec["ranges"] else np.zeros((4, step), np.uint32)
            a, b = np.searchsorted(ids, [r * step, (r + 1) * step])
            out[:, a:b] = self._stats[int(r)][:, ids[a:b] - r * step]
        return out

    def score(self, tokens: np.ndarray, begin: np.ndarray):
        """For each text: tokens, known ones, base score, score."""
        s, v, n = self.spec, self.spec["v"], self.spec["n"]
        ids, count = _ids(tokens, self.vocabulary, v + 1)
        known, where = np.unique(ids, return_inverse=True)
        stats = self.stats(known)
        a, rows = stats[3][where], s["types"]
        if rows:
            d = np.array([0.0, *s["d1"]])
            p = np.maximum(a - d[np.minimum(a, 3)], 0) / rows + s["g1"] / (v + 1)
            keys = _pairs(ids, begin, v)
            distinct, back = np.unique(W.mix(keys), return_inverse=True)
            c = self.pairs.find(distinct)[1][back]
            u = (keys >> np.uint64(32)).astype(np.int64)
            ctx, at = np.unique(u, return_inverse=True)
            few = self.stats(ctx)
            total = np.empty(len(u), np.int64)
            total[1:] = count[:-1]
            total[begin[:-1]] = s["docs"]
            d = np.array([0.0, *s["d2"]])
            left = (few[:3] * d[1:, None]).sum(0)[at]
            seen = np.maximum(total, 1)
            p = np.where(total > 0, np.maximum(c - d[np.minimum(c, 3)], 0) / seen + left / seen * p, p)
        else:
            p = np.full(len(tokens), 1.0 / (v + 1))
        base = np.log10((count + 1.0) / (n + (v + 1.0)))
        add = lambda x: np.add.reduceat(x, begin[:-1])  # noqa: E731  each text has its END at least
        return np.diff(begin), add((count > 0).astype(np.int64)), add(base), add(np.log10(p))


@lru_cache(maxsize=1)
def _model(items: tuple) -> Model:
    return Model(dict(items))


def fit(texts: DataFrame, text: str = "text", path: str | None = None) -> dict:
    """Count a model from a column of texts; gives its description, to be used with score().  Its files are below
    path, which all machines reach; without one, in a shared folder that goes with the application."""
    spark = texts.sparkSession
    prepare(spark)
    path, p = path or shared_dir(spark, "lm"), parts(spark)
    bits = _bits(p)
    only = texts.select(F.col(text).cast("string").alias("text"))
    sizes = (
        only.mapInArrow(_count_words(bits), "shard int, keys binary, counts binary")
        .repartition(p, "shard")
        .mapInArrow(_write_words(path), "shard int, n long, total long")
        .collect()
    )  # one row for each shard
    starts = np.zeros((1 << bits) + 1, np.int64)
    for r in sizes:
        starts[r.shard + 1] = r.n
    starts = np.cumsum(starts)
    v, n = int(starts[-1]), sum(r.total for r in sizes)
    if v + 2 > 1 << 32:
        raise ValueError(f"{v} distinct words: ids of words have 32 bits")
    docs = _end_count(path, bits, starts)
    step = max(1024, -(-(v + 2) // max(8, p // 8)))
    stats = (
        only.mapInArrow(_count_pairs(path, bits, starts.tobytes(), bits), "shard int, u binary, w binary, counts binary")
        .repartition(p, "shard")
        .mapInArrow(_write_pairs(path, step), "kind int, key long, a binary, b binary, c binary, d binary, e binary")
    )
    stats = cut(stats, "lm-stats")
    heads = [[int(W.unplanes(x, np.int64)[0]) for x in r[2:]] + [r.key] for r in stats.filter("kind = -1").collect()]
    ranges = (
        stats.filter("kind >= 0")
        .repartition(max(8, p // 8), "key")
        .mapInArrow(_write_stats(path, step), "range int, n1 long, n2 long, n3 long, n4 long")
        .collect()
    )
    pstarts = np.zeros((1 << bits) + 1, np.int64)
    for h in heads:
        pstarts[h[-1] + 1] = h[0]
    pstarts = np.cumsum(pstarts)
    types = int(pstarts[-1])
    low = [sum(r[f"n{k}"] for r in ranges) for k in (1, 2, 3, 4)]
    d1, d2 = discounts(*low), discounts(*(sum(h[k] for h in heads) for k in (1, 2, 3, 4)))
    more = v - low[0] - low[1]
    g1 = (d1[0] * low[0] + d1[1] * low[1] + d1[2] * more) / types if types else 1.0
    return {"path": path, "vbits": bits, "pbits": bits, "vstarts": starts.tobytes(), "pstarts": pstarts.tobytes(), "step": step, "ranges": tuple(sorted(r.range for r in ranges)), "v": v, "n": n, "docs": docs, "types": types, "d1": tuple(d1), "d2": tuple(d2), "g1": g1}


def _end_count(path: str, bits: int, starts: np.ndarray) -> int:
    """How many documents were counted: the count of END, read by the driver from one shard."""
    s = int(END >> np.uint64(64 - bits))
    if starts[s] == starts[s + 1]:
        return 0
    keys, counts = map_array(f"{path}/words/{s:06d}/keys", "u8"), map_array(f"{path}/words/{s:06d}/counts", "i8")
    at = int(np.searchsorted(keys, END))
    return int(counts[at]) if at < len(keys) and keys[at] == END else 0


def score(df: DataFrame, model: dict, keep: list[Column], text: str = "text") -> DataFrame:
    """The columns keep, then n_tokens, n_known, base_score, score (log10) and perplexity of each row's text."""
    prepare(df.sparkSession)
    items = tuple(model.items())

    def run(batches):
        m = _model(items)
        for batch in batches:
            got = [m.score(t, b) for t, b in _tokens(batch.column(0))]
            if not got:
                continue
            n, known, base, score_ = (np.concatenate(x) for x in zip(*got, strict=True))
            cols = [*(batch.column(i) for i in range(1, batch.num_columns)), pa.array(n.astype(np.int64)), pa.array(known), pa.array(base), pa.array(score_), pa.array(10.0 ** (-score_ / n))]
            yield pa.RecordBatch.from_arrays(cols, names)

    kept = df.select(F.col(text).cast("string").alias("__text"), *keep)
    fields = [f for f in kept.schema.fields if f.name != "__text"]
    names = [f.name for f in fields] + ["n_tokens", "n_known", "base_score", "score", "perplexity"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["n_tokens long", "n_known long", "base_score double", "score double", "perplexity double"])
    return kept.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document is held out of training: crc32(doc_id as text) mod 7 is 2 (a null id: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    out = score(docs, model, [F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out")])
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model["n"]).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")
