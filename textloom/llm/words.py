"""Words of whole batches of texts in vectorised numpy.

A word is a maximal run of bytes other than space and \\t..\\r, A-Z lower-cased: the pattern
[^\\x20\\x09-\\x0D]+ on UTF-8.  A word's hash is a polynomial over per-byte random 64-bit values,
mixed; 0 is never a word's hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240607))
BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
BASE = 0x9E3779B97F4A7C15  # odd
OTHER = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
OTHER_BASE = 0xC2B2AE3D27D4EB4F  # odd
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
CHUNK = 1 << 20
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of the base and of its inverse, modulo 2^64."""
    if base not in _powers or len(_powers[base][0]) < n:
        n = max(n, CHUNK + 4096)
        with np.errstate(over="ignore"):
            _powers[base] = tuple(np.multiply.accumulate(np.concatenate([[U(1)], np.full(n - 1, x, U)])) for x in (base, pow(base, -1, 2**64)))
    return _powers[base]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits (splitmix)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (int64, one more than texts) of a string or binary array; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary() if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_large_string(texts.type) else b"")
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = 2 << 20):
    """Ranges of rows of about so many bytes; a row is never divided."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
        yield a, b
        a = b


def spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes not in space), and the first word of each text (one more at the end)."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~space[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(lowered: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges, which ascend and do not overlap."""
    out = np.empty(len(starts), U)
    i, n = 0, len(starts)
    while i < n:
        a = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, a + CHUNK, "right")))
        b = int(ends[j - 1])
        up, down = powers(b - a + 1)
        with np.errstate(over="ignore"):
            sums = np.empty(b - a + 1, U)
            sums[0] = 0
            np.cumsum(BYTE[lowered[a:b]] * up[: b - a], out=sums[1:])
            s, e = starts[i:j] - a, ends[i:j] - a
            out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U) * U(0xD6E8FEB86659FD93))
        i = j
    out[out == 0] = 1
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes, and the first word of each text (one more at the end)."""
    starts, ends, first = spans(data, offsets)
    return hashes(LOWER[data], starts, ends), first


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words within each text, repeats included (fewer words: all of them as one), and the first of each text."""
    n = np.diff(first)
    counts = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    begin = np.concatenate([[0], np.cumsum(counts)])
    at = np.repeat(first[:-1] - begin[:-1], counts) + np.arange(begin[-1])
    last = np.repeat(first[1:], counts)
    with np.errstate(over="ignore"):
        out = np.zeros(len(at), U)
        for i in range(k):
            p = at + i
            inside = p < last
            out = out * U(BASE) + np.where(inside, h[np.minimum(p, len(h) - 1)], U(0)) if len(h) else out
    return mix(out), begin


def tally(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts (1 each where None)."""
    if not len(keys):
        return keys, np.empty(0, np.int64)
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    if counts is None:
        return keys[at], np.diff(np.concatenate([at, [len(keys)]]))
    return keys[at], np.add.reduceat(counts.astype(np.int64), at)


def planes(a: np.ndarray) -> bytes:
    """Fixed-width integers with equal bytes of all of them together, which the shuffle's codec packs well."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T).tobytes() if len(a) else b""


def unplanes(b: bytes, dtype) -> np.ndarray:
    dtype = np.dtype(dtype)
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(dtype.itemsize, -1).T).reshape(-1).view(dtype) if b else np.empty(0, dtype)
