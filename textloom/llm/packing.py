"""Best-fit packing of token documents into sequences by swap-based local search.

A document is its ids and an end id.  Longer ones than `capacity` are cut into pieces of that length,
the first of which may be shorter; a piece of full length is a sequence of its own.  The others are
dealt at random to groups of a bounded size.  In a group they are placed best fit decreasing, then
local search works on the bins with room: a document of the emptiest bin moves to a fuller one, or is
exchanged one-for-one or two-for-one against smaller ones there, each step increasing the sum of
squared fills, until the bin is empty or no step is left; a group's search ends when TRIES bins in a row
had none.  Full bins are done; the rest of all
groups are dealt anew, until they fit one group or a round saves no sequence (then the one before it stays).

Ids are those of the `tokenizers` library for the given file.  A faster library with the same
vocabulary encodes texts that hold none of the file's special strings, for which both agree.

Nulls are empty texts: the end id alone.  Repeated rows are packed each on its own.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.shared import cut, parts, prepare

CAPACITY, END, GROUP = 1024, 2, 1 << 14
TRIES = 50  # bins in a row without a step after which the search of a group ends; all of them cost 24 times as long and saved none of 22,625 sequences


@lru_cache(maxsize=1)
def _encoder(path: str, ranks: str, pattern: str):
    import base64

    import tiktoken
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    with open(path) as f:
        special = [t["content"] for t in json.load(f).get("added_tokens", [])]
    with open(ranks, "rb") as f:
        fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return np.array(own.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(fast.encode_ordinary(text), np.uint32)

    return encode


def pieces(docs: DataFrame, path: str, ranks: str, pattern: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of docs (doc_id, text)."""
    prepare(docs.sparkSession)

    def run(batches):
        encode = _encoder(path, ranks, pattern)
        for batch in batches:
            out = []
            for at, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encode(text or ""), np.uint32(end)).astype("<u4")
                first = len(ids) % capacity or capacity
                s = 0
                for piece, e in enumerate(range(first, len(ids) + 1, capacity)):
                    out.append((at, piece, s, e - s, zlib.crc32(ids[s:e].tobytes())))
                    s = e
            at, *rest = zip(*out, strict=True) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), *(pa.array(x, t) for x, t in zip(rest, (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best fit decreasing: bins of item numbers.  Bins are found by their room, in a bit set."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = some >> sizes[i]
        if fits:
            r = sizes[i] + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                some &= ~(1 << r)
            bins[b].append(i)
        else:
            r, b = capacity, len(bins)
            bins.append([i])
        r -= sizes[i]
        if r:
            room[r].append(b)
            some |= 1 << r
    return bins


class _Search:
    """Local search over the bins with room."""

    def __init__(self, sizes: list[int], bins: list[list[int]], capacity: int):
        self.size = np.array(sizes, np.int64)
        self.bins, self.capacity = bins, capacity
        self.fill = np.array([sum(sizes[i] for i in b) for b in bins], np.int64)
        self.bin = np.empty(len(sizes), np.int64)
        for b, items in enumerate(bins):
            self.bin[items] = b
        self.items = np.flatnonzero(self.fill[self.bin] < capacity)  # only these can take part
        self.pairs: tuple[np.ndarray, np.ndarray] | None = None

    def _ones(self, items: list[int]) -> dict[int, list[int]]:
        """Documents by length; of one length any is as good as another."""
        out: dict[int, list[int]] = {}
        for i in items:
            out.setdefault(int(self.size[i]), []).append(i)
        return out

    def _twos(self, items: list[int]) -> list[tuple[int, int]]:
        """Two documents, for all pairs of lengths: their number is bounded by the capacity, not by the documents."""
        ones = list(self._ones(items).values())
        return [(x[0], y[0]) for n, x in enumerate(ones) for y in ones[:n]] + [(x[0], x[1]) for x in ones if len(x) > 1]

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Two documents of one bin with room, for all such bins."""
        if self.pairs is None:
            found = [pair for t in np.unique(self.bin[self.items]) for pair in self._twos(self.bins[t])]
            self.pairs = tuple(np.array(found, np.int64).reshape(-1, 2).T)
        return self.pairs

    def _shift(self, out: list[int], back: list[int], d: int, t: int):
        delta = sum(int(self.size[i]) for i in out) - sum(int(self.size[i]) for i in back)
        for i in out:
            self.bins[d].remove(i)
            self.bins[t].append(i)
            self.bin[i] = t
        for i in back:
            self.bins[t].remove(i)
            self.bins[d].append(i)
            self.bin[i] = d
        self.pairs = None
        self.fill[d] -= delta
        self.fill[t] += delta

    def _gain(self, delta: np.ndarray, t: np.ndarray, d: int) -> np.ndarray:
        """How much the sum of squares grows (0: not at all, or no room)."""
        ok = (delta > 0) & (delta <= self.capacity - self.fill[t]) & (t != d) & (self.fill[t] > 0)
        return np.where(ok, 2 * delta * (self.fill[t] - self.fill[d] + delta), 0)

    def _step(self, d: int) -> bool:
        """The best step that takes tokens out of bin d."""
        best, step = 0, None
        own = self.bins[d]
        others = self.items[self.bin[self.items] != d]
        targets = np.unique(self.bin[others])
        singles = [(x[:1], s) for s, x in self._ones(own).items()]
        doubles = [([i, j], int(self.size[i] + self.size[j])) for i, j in self._twos(own)]
        for out, s in singles:  # moves
            g = self._gain(np.full(len(targets), s), targets, d)
            if len(g) and g.max() > best:
                best, step = int(g.max()), (out, [], int(targets[g.argmax()]))
        for out, s in singles + doubles:  # one or two against one
            g = self._gain(s - self.size[others], self.bin[others], d)
            if len(g) and g.max() > best:
                k = int(g.argmax())
                best, step = int(g.max()), (out, [int(others[k])], int(self.bin[others[k]]))
        x, y = self._pairs()
        if len(x):  # one against two
            for out, s in singles:
                g = self._gain(s - self.size[x] - self.size[y], self.bin[x], d)
                if g.max() > best:
                    k = int(g.argmax())
                    best, step = int(g.max()), (out, [int(x[k]), int(y[k])], int(self.bin[x[k]]))
        if step is None:
            return False
        out, back, t = step
        self._shift(out, back, d, t)
        return True

    def run(self) -> list[list[int]]:
        stuck: set[int] = set()
        while True:
            open_ = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity))
            room = int((self.capacity - self.fill[open_]).sum())
            left = [b for b in open_ if b not in stuck]
            if not left or room < self.capacity or len(stuck) > TRIES:  # less room in all than one bin: no bin can be saved
                break
            d = int(min(left, key=lambda b: self.fill[b]))
            if room - (self.capacity - int(self.fill[d])) < self.fill[d]:
                break
            moved = False
            while self.bins[d] and self._step(d):
                moved = True
            if self.bins[d]:
                stuck = stuck | {d} if not moved else {d}
            self.items = self.items[self.fill[self.bin[self.items]] < self.capacity]
        return [b for b in self.bins if b]


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of item numbers, none over capacity."""
    return _Search(sizes, best_fit(sizes, capacity), capacity).run()


def _round(number: int, capacity: int):
    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).sort_by([(c, "ascending") for c in ("group", "length", "doc_id", "piece", "start", "ids_crc32")])
        group = table.column("group").to_numpy()
        edge = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group))
        for s, e in zip(edge[:-1], edge[1:], strict=True):
            part = table.slice(s, e - s).combine_chunks()
            size = part.column("length").to_pylist()
            sequence, offset, full = np.empty(len(size), np.int64), np.empty(len(size), np.int64), np.empty(len(size), bool)
            for b, items in enumerate(pack(size, capacity)):
                at = 0
                for i in items:
                    sequence[i], offset[i] = number << 48 | int(group[s]) << 20 | b, at
                    at += size[i]
                full[items] = at == capacity
            for i in range(0, part.num_rows, 1 << 14):
                x = slice(i, i + (1 << 14))
                yield pa.RecordBatch.from_arrays([*(c.combine_chunks() for c in part.slice(i, 1 << 14).select(COLUMNS).columns), pa.array(sequence[x]), pa.array(offset[x]), pa.array(full[x])], [*COLUMNS, "sequence_id", "offset", "full"])

    return run


COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32"]


def pack_pieces(cuts: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """The rows of cuts (doc_id, piece, start, length, ids_crc32; each length 1 to capacity) with sequence_id and offset."""
    spark = cuts.sparkSession
    prepare(spark)
    cuts = cut(cuts, "pieces")
    whole = cuts.filter(F.col("length") == capacity).select(*COLUMNS, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest, done, number, before, bins = cuts.filter(F.col("length") < capacity), [whole], 0, None, 0
    n = rest.count()
    while n:
        number += 1
        groups = -(-n // group)
        dealt = rest.withColumn("group", F.pmod(F.xxhash64(*COLUMNS, F.lit(number)), F.lit(groups)) if groups > 1 else F.lit(0).cast("long"))
        dealt = dealt.repartition(max(1, groups), "group")
        out = cut(dealt.mapInArrow(_round(number, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, full boolean"), "packed")
        made = out.groupBy("full").agg(F.count_distinct("sequence_id").alias("bins"), F.count("*").alias("n")).collect()  # two rows
        if before is not None and sum(r.bins for r in made) >= bins:
            done.append(before.drop("full"))
            break
        done.append(out.filter("full").drop("full"))
        before, rest = out.filter("not full"), out.filter("not full").select(COLUMNS)
        n, bins = next(((r.n, r.bins) for r in made if not r.full), (0, 0))
        if groups == 1:
            done.append(before.drop("full"))
            break
    packed = done[0]
    for d in done[1:]:
        packed = packed.unionByName(d)
    return packed


def pack_documents(docs: DataFrame) -> DataFrame:
    import public_tokenizers as public

    return pack_pieces(pieces(docs, public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN))


def query(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
