import random

import public_tokenizers as public
import pytest
import sentencepiece

from textloom.llm import pieces
from textloom.llm.queries import QUERIES

PATH = public.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", "\n", "a", " a", "a ", "▁", "a▁b ▁ c", "<s> </s> <unk> <0x0A>", "x\0y", "\t\r\n  x", "né é ﬁ　Ａ", "日本語テキスト", "😀😀 👩‍👩‍👧", "1234567890", "a" * 5000, "ab" * 40 + " " + "ab" * 40, " " * 300 + "x", "word " * 3000, "don't stop,now…ok", "\n\n\n", "Ωμέγα и привет", "a ·b · \r\n \r", "x²·y", "据数 取获 一个 ال──══"]


@pytest.fixture(scope="module")
def library():
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    return lambda text: len(model.encode(text or ""))


def texts(seed, n):
    rng = random.Random(seed)
    parts = ["the", "of", "▁", " ", "  ", "\n", "é", "ing", "日", "本", ",", ".", "..", "<s>", "0", "42", "XYZ", "·", "\r", "и", "«", "\0", "qu" * 30, "😀"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(n)]


@pytest.mark.parametrize("frequent", [0, 7, 1 << 16])
def test_as_the_library_counts(spark, library, frequent):
    given = ODD + texts(3, 300)
    rows = [(None if i % 9 == 0 else i // 2, t) for i, t in enumerate(given)] * 2  # ids repeat and lack
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = pieces.token_counts(docs, PATH, frequent=frequent).collect()
    want = [(i, len((t or "").encode()), library(t)) for i, t in rows]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)


def test_query(spark, sf, library):
    want = {r.doc_id: library(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op12_token_counts"](spark, sf).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want and len(got) == len(want)
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got) and any(r.over_limit for r in got)


def test_each_pretoken_once_and_borders(spark, library):
    docs = spark.createDataFrame([(t,) for t in ["so far so good", "so\nfar", "good  so"]], "text string")
    table = {r.name: (r.n, r.pieces) for r in pieces.piece_counts(docs, PATH).collect()}
    assert set(table) == {" so", " far", " good", "far", "\n", "  so"} and table[" so"][0] == 3 and table["\n"] == (1, 1)
    load = pieces.load(PATH)
    for t in filter(None, ODD + texts(5, 200)):
        assert "".join(load.split(t)) == " " + t.replace("▁", " ") and sum(load.counts(load.split(t))) == library(t)


def test_columns_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b", 2)], "doc_id long, text string, name int")
    assert [tuple(r) for r in pieces.token_counts(docs, PATH).select("doc_id", "name", "n_bytes", "n_tokens").collect()] == [(1, 2, 3, 2)]
    for clash in ("n_tokens", "N_BYTES"):
        with pytest.raises(ValueError, match="rename"):
            pieces.token_counts(docs.withColumnRenamed("name", clash), PATH)
    assert pieces.token_counts(docs.limit(0), PATH).count() == 0


def test_keys_of_the_join_are_rare(spark):
    """No key of the joined pairs is among the most frequent, whatever its length."""
    hot = "x" * 400
    docs = spark.createDataFrame([(f"{hot} w{i}",) for i in range(200)], "text string")
    table = pieces.piece_counts(docs, PATH)
    top = table.orderBy("n", ascending=False).first()
    assert top.n == 200 and len(top.name) == 34
