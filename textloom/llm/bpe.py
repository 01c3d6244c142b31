"""Byte-level BPE by a segment tree over byte positions.

For a piece of text (a match of the splitting pattern) the tree's leaf i holds (rank, i) of the pair
that starts with the live token at byte i, and each node the least of its two: the root is the
leftmost pair of least rank.  A merge changes the leaves of the new token, of the token it took in
and of the live neighbour before it, each by an update along one path to the root.  Distinct pieces
are encoded many at a time, one row of arrays each, so the trees of a block are updated together.

Nulls are empty texts, which have no tokens.  A piece that is itself in the vocabulary is one token.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.shared import prepare

NONE = np.int64(2**62)
CELLS, REMEMBER, SLICE = 1 << 19, 300_000, 1 << 20


class Bpe:
    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = {i: t for t, i in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.pairs = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in sorted(pairs)], np.int64)

    def _leaf(self, a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
        """(rank, place) of the pairs of tokens a and b, or NONE."""
        key = a << 32 | b
        i = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[i] == key, self.merged[i] << 32 | at, NONE)

    def _merge(self, pieces: list[bytes], size: int) -> list[list[int]]:
        """Tokens of pieces of at most `size` (a power of two) bytes."""
        m = len(pieces)
        length = np.array([len(p) for p in pieces])
        raw = np.zeros((m, size), np.uint8)
        inside = np.arange(size) < length[:, None]
        raw[inside] = np.frombuffer(b"".join(pieces), np.uint8)
        token = self.single[raw]
        after = np.tile(np.arange(1, size + 1), (m, 1))
        before = np.tile(np.arange(-1, size - 1), (m, 1))
        live = inside.copy()
        tree = np.full((m, 2 * size), NONE, np.int64)
        both = inside[:, 1:]
        tree[:, size : 2 * size - 1][both] = self._leaf(token[:, :-1][both], token[:, 1:][both], np.broadcast_to(np.arange(size - 1), both.shape)[both])
        width = size
        while width > 1:
            level = tree[:, width : 2 * width]
            width //= 2
            tree[:, width : 2 * width] = np.minimum(level[:, ::2], level[:, 1::2])

        def update(rows, at, value):
            node = at + size
            tree[rows, node] = value
            while node[0] > 1:  # all leaves are at one depth
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        rows = np.arange(m)
        while len(rows := rows[tree[rows, 1] < NONE]):
            best = tree[rows, 1]
            i, rank = best & 0xFFFFFFFF, best >> 32
            j = after[rows, i]
            k = after[rows, j]
            token[rows, i] = rank
            live[rows, j] = False
            after[rows, i] = k
            more = k < length[rows]
            before[rows[more], k[more]] = i[more]
            update(rows, j, NONE)
            update(rows, i, np.where(more, self._leaf(rank, token[rows, np.minimum(k, size - 1)], i), NONE))
            p = before[rows, i]
            some = p >= 0
            if some.any():
                r, p = rows[some], p[some]
                update(r, p, self._leaf(token[r, p], rank[some], p))
        ids = token[live].tolist()
        cuts = np.concatenate([[0], np.cumsum(live.sum(1))]).tolist()
        return [ids[s:e] for s, e in zip(cuts[:-1], cuts[1:], strict=True)]

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Token ids of each piece."""
        out: list = [None] * len(pieces)
        by_size: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            rank = self.ranks.get(p)
            if rank is not None:
                out[i] = [rank]
            elif not p:
                out[i] = []
            else:
                by_size.setdefault(1 << (len(p) - 1).bit_length(), []).append(i)
        for size, who in by_size.items():
            step = max(1, CELLS // size)
            for a in range(0, len(who), step):
                some = who[a : a + step]
                for i, ids in zip(some, self._merge([pieces[i] for i in some], size), strict=True):
                    out[i] = ids
        return out

    def encode(self, text: str) -> list[int]:
        return [t for ids in self.encode_pieces([p.encode() for p in self.find(text)]) for t in ids]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> Bpe:
    return Bpe(path, pattern)


class _Known:
    """What distinct pieces give, by their number: how many ids, ids as text, decoded bytes.  Forgotten when there are many."""

    def __init__(self, bpe: Bpe):
        self.bpe, self.names = bpe, {i: str(i) for i in bpe.bytes_of}
        self.clear()

    def clear(self):
        self.at: dict[str, int] = {}
        self.n: list[int] = []
        self.ids: list[str] = []
        self.raw: list[bytes] = []

    def learn(self, pieces: set[str]):
        if len(self.n) > REMEMBER:
            self.clear()
        new = list(pieces.difference(self.at))
        name, raw = self.names.__getitem__, self.bpe.bytes_of.__getitem__
        made = self.bpe.encode_pieces([p.encode() for p in new])
        self.at.update(zip(new, range(len(self.n), len(self.n) + len(new)), strict=True))
        self.n += map(len, made)
        self.ids += [" ".join(map(name, ids)) for ids in made]
        self.raw += [b"".join(map(raw, ids)) for ids in made]

    def digests(self, pieces: list[str]) -> tuple[int, str, str]:
        at = list(map(self.at.__getitem__, pieces))
        ids, raw = " ".join(map(self.ids.__getitem__, at)), b"".join(map(self.raw.__getitem__, at))
        return sum(map(self.n.__getitem__, at)), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(raw).hexdigest()


def _texts(texts: list, size: int = SLICE):
    """Lists of texts (null: empty) of about so many characters."""
    held, n = [], 0
    for t in texts:
        held.append(t or "")
        n += len(held[-1])
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """docs without the text, with n_tokens, ids_sha256 (of decimal ids joined by a space) and decoded_sha256."""
    prepare(docs.sparkSession)
    kept = [c for c in docs.columns if c != text]

    def run(batches):
        known = _Known(load(path, pattern))
        for batch in batches:
            out = []
            for texts in _texts(batch.column(0).to_pylist()):
                pieces = [known.bpe.find(t) for t in texts]
                known.learn(set().union(*pieces))
                out += map(known.digests, pieces)
            n, ids, raw = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(raw, pa.string())], [*kept, "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept] + ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"])
    return docs.select(F.col(text).cast("string").alias(text), *kept).mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """docs with a column ids (array of int) in place of the text."""
    prepare(docs.sparkSession)
    kept = [c for c in docs.columns if c != text]

    def run(batches):
        bpe = load(path, pattern)
        for batch in batches:
            for i, texts in _numbered(batch.column(0).to_pylist()):
                pieces = [bpe.find(t) for t in texts]
                distinct = list(set().union(*pieces))
                ids = dict(zip(distinct, bpe.encode_pieces([p.encode() for p in distinct]), strict=True))
                yield pa.RecordBatch.from_arrays([*(c.slice(i, len(texts)) for c in batch.columns[1:]), pa.array([[t for p in own for t in ids[p]] for own in pieces], pa.list_(pa.int32()))], [*kept, "ids"])

    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept] + ["ids array<int>"])
    return docs.select(F.col(text).cast("string").alias(text), *kept).mapInArrow(run, schema)


def _numbered(texts: list):
    i = 0
    for some in _texts(texts):
        yield i, some
        i += len(some)


def decode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """docs with a binary column decoded in place of ids."""
    prepare(docs.sparkSession)
    kept = [c for c in docs.columns if c != "ids"]

    def run(batches):
        bpe = load(path, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array([bpe.decode(ids or ()) for ids in batch.column(0).to_pylist()], pa.binary())], [*kept, "decoded"])

    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept] + ["decoded binary"])
    return docs.select("ids", *kept).mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
