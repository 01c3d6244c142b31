"""Suffix-array dedup: every byte covered by a `length`-byte string that starts anywhere else goes.

1. Distinct texts (equal ones are counted).  A text of at least `length` bytes with a copy goes whole.
2. Anchors: each window of `length` bytes has the leftmost of its `gram`-byte strings with the least
   hash as its anchor, so equal windows have equal anchors.  Runs of windows with one anchor are dealt
   by its hash, each with the hash of its hull, the bytes of them all.  Hulls that occur twice are
   removed at once.
3. What is left of a group of equal anchors with different hulls are the edges of repeats.  One
   fragment for each different hull goes to a batch of whole groups: suffixes are sorted, and from the
   Burrows-Wheeler transform a breadth-first backward extension finds the boundaries between
   suffixes with common prefixes of 0, 1, 2 .. bytes, stopping at `length`.  Suffixes no boundary
   parts have a common prefix of `length` or more.
4. Groups with more than `group` different hulls are not gathered: their windows are counted by
   digest in Spark instead, so that no group is unbounded.  Both ways find the same (tests).

Texts and counted windows are told apart by 128-bit hashes, hulls of one anchor by 96 bits beside the
anchor's 64; fragments are compared by their bytes.
Any byte can occur in a text, 0 included.  Nulls are empty texts.  Repeated rows are documents of their own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm import words as W
from textloom.llm.shared import parts, prepare, text_key

LENGTH, GRAM, GROUP, BATCH, PIECE = 200, 100, 1 << 14, 1 << 19, 1 << 20


def _least(h: np.ndarray, w: int, pick=np.minimum) -> np.ndarray:
    """Least (or largest) of h[i : i + w], for each i where that is whole."""
    m, span = h, 1
    while span * 2 <= w:
        m = pick(m[:-span], m[span:])
        span *= 2
    return pick(m[: len(h) - w + 1], m[w - span : len(h) - span + 1]) if span < w else m


def _sums(data: np.ndarray, table: np.ndarray = W.BYTE, base: int = W.BASE) -> tuple[np.ndarray, np.ndarray]:
    up, down = W.powers(len(data) + 1, base)
    out = np.zeros(len(data) + 1, W.U)
    with np.errstate(over="ignore"):
        np.cumsum(table[data] * up[: len(data)], out=out[1:])
    return out, down


def _hash(sums, down, s, e):
    with np.errstate(over="ignore"):
        return W.mix((sums[e] - sums[s]) * down[s])


def runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of windows with one anchor, of texts laid end to end: text, first window's place in it, windows,
    hash of the anchor, two hashes of the hull (the bytes of all the run's windows)."""
    w = length - gram + 1
    n = len(data)
    inside = np.zeros(n + 1, np.int32)
    np.add.at(inside, offsets[:-1], 1)
    np.add.at(inside, np.maximum(offsets[:-1], offsets[1:] - length + 1), -1)
    whole = np.cumsum(inside[:-1]) > 0  # a window starts here
    for a in range(0, n, PIECE):
        b = min(n, a + PIECE)
        hi = min(n, b + length)
        if hi - a < length or not whole[a:b].any():
            continue
        sums, down = _sums(data[a:hi])
        h = _hash(sums, down, slice(0, hi - a - gram + 1), slice(gram, hi - a + 1))
        m = _least(h, w)[: b - a]
        ok = whole[a : a + len(m)]
        # the anchor, the leftmost least gram, changes where the least does, or where it leaves the window
        new = np.ones(len(m), bool)
        new[1:] = (m[1:] != m[:-1]) | (h[: len(m) - 1] == m[:-1]) | ~ok[:-1]
        first = np.flatnonzero(new & ok)
        edge = np.flatnonzero(np.append(new | ~ok, True))
        count = edge[np.searchsorted(edge, first, "right")] - first
        text = np.searchsorted(offsets, first + a, "right") - 1
        end = first + count + length - 1
        with np.errstate(over="ignore"):
            hull = W.mix(_hash(sums, down, first, end) + count.astype(W.U))
        yield text, first + a - offsets[text], count, m[first], hull, _hash(*_sums(data[a:hi], W.OTHER, W.OTHER_BASE), first, end)


def _emit_runs(buckets: int, length: int, gram: int):
    def flush(held, names):
        a, f, g, t, p, c = map(np.concatenate, zip(*held, strict=True))
        names = np.concatenate(names)
        bucket = (a >> W.U(33)).astype(np.int64) % buckets
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for i in np.flatnonzero(np.diff(cuts)):
            at = order[cuts[i] : cuts[i + 1]]
            who, own = np.unique(t[at], return_inverse=True)
            blobs = (a[at], f[at], g[at], own.astype(np.uint32), p[at], c[at], names[who].ravel())
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), *(pa.array([W.planes(x)], pa.binary()) for x in blobs)], ["bucket", *"afgtpcn"])

    def run(batches):
        held, names, n, ids = [], [], 0, 0
        for batch in batches:
            names.append(np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], 1))
            data, offsets = W.buffers(batch.column(2))
            for i, j in W.slices(offsets):
                off = offsets[i : j + 1]
                for text, place, count, h, hull, other in runs(data[off[0] : off[-1]], off - off[0], length, gram):
                    held.append((h, hull, other.astype(np.uint32), ids + i + text, place.astype(np.uint32), count.astype(np.uint16)))
                    n += len(h)
            ids += batch.num_rows
            if n > 1 << 20:
                yield from flush(held, names)
                held, names, n, ids = [], [], 0, 0
        if n:
            yield from flush(held, names)

    return run


def _group(limit: int):
    """From the runs of buckets, in order: kind 0 where the hull is a repeat; 1, one run for each hull of a group with several; 2, the same for a large group."""

    def of(held):
        base = np.cumsum([0, *(len(x[6]) // 2 for x in held)])
        t = np.concatenate([x[3] + b for x, b in zip(held, base[:-1], strict=True)]).astype(np.int64)
        a, f, g, p, c, names = (np.concatenate([x[i] for x in held]) for i in (0, 1, 2, 4, 5, 6))
        names = names.reshape(-1, 2)
        order = np.lexsort((p, t, g, f, a))
        a, f, g, t, p, c = a[order], f[order], g[order], t[order], p[order], c[order]
        newa = np.concatenate([[True], a[1:] != a[:-1]])
        newf = newa | np.concatenate([[True], (f[1:] != f[:-1]) | (g[1:] != g[:-1])])
        ga, gf = np.cumsum(newa) - 1, np.cumsum(newf) - 1
        hulls = np.bincount(ga, newf)[ga]
        again = np.bincount(gf)[gf] > 1
        edge = newf & (hulls > 1)
        for rows, kind in ((again, np.zeros(len(a), np.int32)), (edge, np.where(hulls > limit, 2, 1).astype(np.int32))):
            at = np.flatnonzero(rows)
            for i in range(0, len(at), 1 << 15):
                x = at[i : i + (1 << 15)]
                yield pa.RecordBatch.from_arrays([pa.array(names[t[x], 0]), pa.array(names[t[x], 1]), pa.array(p[x].astype(np.int64)), pa.array(c[x].astype(np.int32)), pa.array(kind[x]), pa.array(a[x].view(np.int64))], ["k1", "k2", "place", "windows", "kind", "anchor"])

    def run(batches):
        held, now = [], None
        for batch in batches:
            for b, *blobs in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
                if b != now and held:
                    yield from of(held)
                    held = []
                now = b
                held.append([W.unplanes(x, d) for x, d in zip(blobs, ("u8", "u8", "u4", "u4", "u4", "u2", "i8"), strict=True)])
        if held:
            yield from of(held)

    return run


def _fragments(length: int):
    """(key, k1, k2, start, end, raw): spans of kind 0 as they are; fragments of kind 1 by anchor; windows of kind 2 by digest (its other half is raw)."""

    def run(batches):
        for batch in batches:
            rows = []
            for k1, k2, text, found in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                raw = text.encode()
                whole: list[list[int]] = []
                for r in sorted(found, key=lambda r: r["place"]):
                    s = r["place"]
                    e = s + r["windows"] + length - 1
                    if r["kind"] == 0:
                        if whole and s <= whole[-1][1]:
                            whole[-1][1] = max(e, whole[-1][1])
                        else:
                            whole.append([s, e])
                    elif r["kind"] == 1:
                        rows.append((r["anchor"], k1, k2, s, e, raw[s:e]))
                    else:
                        for w in range(s, e - length + 1):
                            digest = hashlib.blake2b(raw[w : w + length], digest_size=16).digest()
                            rows.append((int.from_bytes(digest[:8], "little", signed=True), k1, k2, w, -1, digest[8:]))
                rows += [(k1, k1, k2, s, e, None) for s, e in whole]
                if len(rows) > 2000:
                    yield pack(rows)
                    rows = []
            if rows:
                yield pack(rows)

    def pack(rows):
        columns = [pa.array(x, pa.binary() if i == 5 else pa.int64()) for i, x in enumerate(zip(*rows, strict=True))]
        return pa.RecordBatch.from_arrays(columns, ["key", "k1", "k2", "start", "end", "raw"])

    return run


# --- Burrows-Wheeler transform ---------------------------------------------------------------


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of text (uint8) sorted by their first `depth` bytes or more; ties in any order."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key |= padded[j : j + n] << np.uint64(8 * (7 - j))
    h = 8
    while True:
        order = np.argsort(key)
        inorder = key[order]
        new = np.zeros(n, np.int64)
        new[1:] = inorder[1:] != inorder[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) + 1
        if h >= depth or rank[order[-1]] == n:
            return order
        after = np.zeros(n, np.int64)
        after[: max(0, n - h)] = rank[h:]
        key = (rank << 32 | after).view(np.uint64)
        h *= 2


def boundaries(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix, in order, has less than `length` bytes in common with the one before.

    text ends with its least value, which ends each piece and occurs in none; suffixes with it among their
    first `length` may be parted elsewhere within their own bucket.  All others are exact.
    """
    alphabet, code = np.unique(text, return_inverse=True)
    n = len(text)
    bwt = code[order - 1]  # the byte before each suffix; before the first, the last
    by_byte = np.argsort(bwt.astype(np.uint8), kind="stable")
    back = np.empty(n, np.int32)  # where each suffix stands with its byte before it
    back[by_byte] = np.arange(n, dtype=np.int32)
    same = np.empty(n, np.int32)  # the last place before with the same byte
    same[by_byte[1:]] = by_byte[:-1]
    first = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(alphabet)))])
    same[by_byte[first[:-1]]] = -1
    apart = np.zeros(n + 1, bool)
    apart[first] = True
    frontier = np.unique(first[:-1])
    for _ in range(length - 1):
        # each new boundary opens an interval, up to the next boundary: its bytes' first places lead back
        found = []
        for at, start in _inside(apart, frontier):
            to = back[at[same[at] < start]]
            to = to[~apart[to]]
            found.append(to)
        frontier = np.concatenate(found)  # each place once: it has one place that leads to it
        if not len(frontier):
            break
        apart[frontier] = True
    return apart[:-1]


def _inside(apart: np.ndarray, frontier: np.ndarray):
    """All places of the intervals that the boundaries open, each with its boundary."""
    at = start = frontier
    for _ in range(32):
        yield at, start
        at = at + 1
        on = ~apart[at]
        at, start = at[on], start[on]
        if not len(at):
            return
    edges = np.flatnonzero(apart)
    end = edges[np.searchsorted(edges, at, "right")]
    for i in range(0, len(at), 1 << 12):
        n = (end - at)[i : i + (1 << 12)]
        first = np.cumsum(n) - n
        places = np.repeat(at[i : i + (1 << 12)] - first, n) + np.arange(n.sum())
        yield places, np.repeat(start[i : i + (1 << 12)], n)


def repeats(pieces: list[bytes], owner: np.ndarray, start: np.ndarray, length: int):
    """Of fragments of texts (owner, start in it): (owner, start, end) of runs of windows that also start elsewhere."""
    text = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8) + np.uint8(1)  # UTF-8 has no 255: as 0 it ends each piece, below all bytes
    size = np.array([len(p) for p in pieces])
    begin = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
    whole = np.zeros(len(text) + 1, np.int32)
    np.add.at(whole, begin, 1)
    np.add.at(whole, begin + np.maximum(size - length + 1, 0), -1)
    whole = np.cumsum(whole[:-1]) > 0
    order = suffix_order(text, length)
    group = np.cumsum(boundaries(text, order, length)) - 1
    piece = np.repeat(np.arange(len(pieces)), size + 1)
    place = np.arange(len(text)) - begin[piece] + start[piece]
    name = (owner[piece] << 32 | place)[order]
    ok = whole[order]
    name, group, at = name[ok], group[ok], order[ok]
    edge = np.flatnonzero(np.diff(group, prepend=-1))
    if not len(edge):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    differ = np.minimum.reduceat(name, edge) != np.maximum.reduceat(name, edge)
    at = np.sort(at[np.repeat(differ, np.diff(np.append(edge, len(name))))])
    if not len(at):
        return at, at, at
    head = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    tail = np.append(head[1:], len(at)) - 1
    return owner[piece[at[head]]], place[at[head]], place[at[tail]] + length


def _extend(length: int):
    """Spans of kind 0 as they are, and those found in groups of fragments or among counted windows."""

    def out(k1, k2, s, e):
        return pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), pa.array(s << 32 | e)], ["k1", "k2", "span"])

    def counted(key, k1, k2, start, raw):
        other = np.frombuffer(b"".join(raw.to_pylist()), np.int64)
        order = np.lexsort((other, key))
        key, other = key[order], other[order]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (other[1:] != other[:-1])])
        twice = order[(np.bincount(np.cumsum(new) - 1) > 1)[np.cumsum(new) - 1]]
        return out(k1[twice], k2[twice], start[twice], start[twice] + length)

    def run(batches):
        held = []
        for batch in batches:
            known = batch.column("raw").is_null().to_numpy(zero_copy_only=False)
            if known.any():
                x = batch.filter(pa.array(known))
                yield out(*(x.column(c).to_numpy() for c in ("k1", "k2", "start", "end")))
            if not known.all():
                held.append(batch.filter(pa.array(~known)))
        if not held:
            return
        table = pa.Table.from_batches(held)
        del held
        key, k1, k2, start, end = (table.column(c).to_numpy() for c in ("key", "k1", "k2", "start", "end"))
        raw = table.column("raw").combine_chunks()
        del table
        single = np.flatnonzero(end < 0)
        if len(single):
            yield counted(key[single], k1[single], k2[single], start[single], raw.take(pa.array(single)))
        order = np.flatnonzero(end >= 0)
        order = order[np.argsort(key[order], kind="stable")]
        key, k1, k2, start = key[order], k1[order], k2[order], start[order]
        edge = np.append(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else key), len(key))
        i = 0
        while i < len(edge) - 1:
            j, size = i, 0
            while j < len(edge) - 1 and (j == i or size < BATCH):
                size += (edge[j + 1] - edge[j]) * (length * 3 // 2)
                j += 1
            at = slice(edge[i], edge[j])
            if edge[j] - edge[i] > 1:
                names, owner = np.unique(np.stack([k1[at], k2[at]], 1), axis=0, return_inverse=True)
                t, s, e = repeats(raw.take(pa.array(order[at])).to_pylist(), owner.ravel(), start[at], length)
                if len(t):
                    yield out(names[t, 0], names[t, 1], s, e)
            i = j

    return run


def _finish(length: int, points: bool):
    def run(batches):
        for batch in batches:
            out = []
            for text, copies, spans_ in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                raw = text.encode()
                runs: list[list[int]] = []
                if copies > 1 and len(raw) >= length:
                    runs = [[0, len(raw)]]
                for x in sorted(spans_ or []) if not runs else ():
                    s, e = x >> 32, min(x & 0xFFFFFFFF, len(raw))
                    if runs and s <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], e)
                    else:
                        runs.append([s, e])
                kept, last = [], 0
                for s, e in [*runs, [len(raw), len(raw)]]:
                    part = raw[last:s]
                    kept.append(part.decode(errors="ignore").encode() if points and runs else part)  # only its ends can be parts of code points
                    last = e
                out.append((runs, b"".join(kept), len(raw)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([n for *_, n in out], pa.int64()), pa.array([sum(e - s for s, e in r) for r, *_ in out], pa.int64()), pa.array([len(r) for r, *_ in out], pa.int64()), pa.array([k for _, k, _ in out], pa.binary()), pa.array([[{"start": s, "end": e} for s, e in r] for r, *_ in out], SPANS)],
                ["k1", "k2", "n_bytes", "n_removed", "n_spans", "kept", "spans"],
            )

    return run


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def remove_repeats(docs: DataFrame, length: int = LENGTH, group: int = GROUP, gram: int | None = None, text: str = "text", points: bool = False) -> DataFrame:
    """For each distinct text: k1, k2 (text_key of it), n_bytes, n_removed, n_spans, kept (binary: the bytes
    that stay; not always whole UTF-8) and spans (start, end of maximal removed runs).  points: of a code
    point that a run cuts through no byte stays, so that kept is UTF-8 (n_removed counts the runs alone)."""
    gram = gram or max(1, length * GRAM // LENGTH)
    if not 1 <= gram < length < 1 << 16:
        raise ValueError("1 <= gram < length < 65536")
    spark = docs.sparkSession
    prepare(spark)
    p = parts(spark)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    distinct = docs.select(*text_key(F.col(text).cast("string")), body.alias("text")).groupBy("k1", "k2").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    found = (
        distinct.select("k1", "k2", "text")
        .mapInArrow(_emit_runs(p, length, gram), "bucket int, " + ", ".join(f"{c} binary" for c in "afgtpcn"))
        .repartition(p, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_group(group), "k1 long, k2 long, place long, windows int, kind int, anchor long")
    )
    edges = found.groupBy("k1", "k2").agg(F.collect_list(F.struct("place", "windows", "kind", "anchor")).alias("found"))
    fragments = distinct.join(edges, ["k1", "k2"]).select("k1", "k2", "text", "found").mapInArrow(_fragments(length), "key long, k1 long, k2 long, start long, end long, raw binary")
    extended = fragments.repartition(2 * p, "key").mapInArrow(_extend(length), "k1 long, k2 long, span long")
    spans_ = extended.groupBy("k1", "k2").agg(F.collect_list("span").alias("spans"))
    return distinct.join(spans_, ["k1", "k2"], "left").select("k1", "k2", "text", "copies", "spans").mapInArrow(_finish(length, points), "k1 long, k2 long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<struct<start:long,end:long>>")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = remove_repeats(docs).select("k1", "k2", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    return docs.select("doc_id", *text_key(F.col("text"))).join(found, ["k1", "k2"]).drop("k1", "k2")
