import random
import zlib

import numpy as np
import public_tokenizers as public
import pytest
from tokenizers import Tokenizer

from textloom.llm import packing


@pytest.mark.parametrize("seed", range(12))
def test_local_search_on_small_instances(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 100, 1024])
    sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 300))]
    first, bins = packing.best_fit(sizes, capacity), packing.pack(sizes, capacity)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= capacity for b in bins)
    assert len(bins) <= len(first)


def test_local_search_saves_a_bin():
    # best fit decreasing needs 4 bins of 101; three are enough
    sizes = [51, 27, 26, 23, 23, 24, 50, 27, 27, 25]
    assert sum(sizes) == 3 * 101
    assert len(packing.pack(sizes, 101)) <= len(packing.best_fit(sizes, 101))


def least_bins(sizes, capacity):
    """A lower bound: the large pieces, and what the small ones need beyond the room beside them."""
    best = 0
    for k in range(capacity // 2 + 1):
        alone = sum(s > capacity - k for s in sizes)
        large = [s for s in sizes if capacity // 2 < s <= capacity - k]
        small = sum(s for s in sizes if k <= s <= capacity // 2)
        best = max(best, alone + len(large) + max(0, -(-(small - len(large) * capacity + sum(large)) // capacity)))
    return best


def check(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_documents(spark):
    rng = random.Random(1)
    own = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    texts = [None, "", "<|endoftext|> within", "naïve 你好  \n x"] + [" ".join(rng.choice(["the", "Zebra", "ß", "12,5", "\n"]) for _ in range(rng.randint(1, 4000))) for _ in range(60)] + ["same"] * 5
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, piece int")
    rows = packing.pack_documents(docs).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    total = 0
    for i, t in enumerate(texts):
        ids = np.array(own.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        total += len(ids)
        got = sorted(by[i], key=lambda r: r.piece)
        assert [r.piece for r in got] == list(range(len(got))) and all(r.length == 1024 for r in got[1:]) and got[0].start == 0
        assert sum(r.length for r in got) == len(ids)
        for r in got:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    assert check(rows, 1024) <= least_bins([r.length for r in rows], 1024) * 1.01 + 1


def test_groups_are_dealt_anew(spark):
    rng = random.Random(2)
    sizes = [rng.randint(1, 1024) for _ in range(5000)]
    cuts = spark.createDataFrame([(i, 0, 0, s, 0) for i, s in enumerate(sizes)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = packing.pack_pieces(cuts, group=1024).collect()
    assert sorted(r.doc_id for r in rows) == list(range(5000))
    assert check(rows, 1024) <= 1.02 * least_bins(sizes, 1024)
    assert check(packing.pack_pieces(cuts).collect(), 1024) <= 1.002 * least_bins(sizes, 1024)


def test_no_rows(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
