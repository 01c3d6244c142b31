import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from textloom.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(6)
    out = [None, "", " ", "a", "aaaaaaa" * 300, "   \n\n  x  ", "don't we'll 'S", "naïve café €uro 你好世界 🙂🙂", "1234567890" * 20, "<|endoftext|> x", "\x00\x01", "ab" * 700]
    out += ["".join(rng.choice("abcdeé .,'\n0 ​你🙂") for _ in range(rng.randint(1, 400))) for _ in range(60)]
    return out


def test_encodes_as_the_library_would(spark, reference):
    rows = texts()
    docs = spark.createDataFrame([(i, t, "n") for i, t in enumerate(rows)], "doc_id long, text string, n_tokens string").drop("n_tokens")
    got = {r.doc_id: r for r in bpe.digests(docs, PATH, PATTERN).collect()}
    for i, t in enumerate(rows):
        ids = reference.encode_ordinary(t or "")
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())


def test_round_trip(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    back = bpe.decode(bpe.encode(docs, PATH, PATTERN), PATH, PATTERN)
    assert back.join(docs, "doc_id").filter("cast(decoded as string) <> text or decoded is null").count() == 0


def test_no_rows(spark):
    assert bpe.digests(spark.createDataFrame([], "doc_id long, text string"), PATH, PATTERN).count() == 0
