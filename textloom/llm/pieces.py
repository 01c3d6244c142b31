"""Token counts without token ids: each distinct pre-token is counted once.

A pre-token is a part of a text that the merges of a byte-fallback BPE model can't leave: a run of spaces with
the run of characters of one class after it, or with the one character that is in no class.  Classes come from
the vocabulary: characters that stand side by side in a piece are of one class (as it turns out, letters of a
script, or punctuation).  No piece holds characters of two classes, nor a space after something else, so pieces
never cross these borders and counts add up.

One pass over the texts gives the pre-tokens' frequencies, summed in tasks before the shuffle; the model then
counts the pieces of each distinct pre-token once, into a table.  The counts of the most frequent ones (at most
FREQUENT, names of bounded length, so the size is bounded) are broadcast to the second pass, which sums them
by text; the other pairs of text and pre-token are joined with the table by Spark, and no such key holds more
than a share of 1 / FREQUENT of all pre-tokens.  Long pre-tokens are named by 128 bits of a hash.

Defined results: a null text is empty and has no tokens; U+2581 is a space, as in the library.  Equal rows are
counted one by one, null and repeated ids as well, as ids are no keys here.  Other columns pass through;
columns named n_bytes or n_tokens must be renamed first (an error says so).  No rows give no rows.  A text may
be of any length that fits a task; only its distinct pre-tokens are held.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.shared import cut, prepare, unfit

FREQUENT, NAME, HELD, BATCH = 1 << 16, 48, 200_000, 4096


def _classes(pieces: list[str]) -> list[str]:
    """Characters that pieces join, directly or by way of others: no piece holds characters of two classes."""
    root: dict[str, str] = {}

    def find(c: str) -> str:
        while root.setdefault(c, c) != c:
            c = root[c]
        return c

    for p in pieces:
        for a, b in zip(p, p[1:], strict=False):
            root[find(a)] = find(b)
    classes: dict[str, str] = {}
    for c in sorted(root):
        classes[find(c)] = classes.get(find(c), "") + c
    return sorted(classes.values(), key=len, reverse=True)


class Pieces:
    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        if m.normalize("ﬁ  é　Ａ ") != "▁ﬁ▁▁é　Ａ▁":
            raise ValueError("the model must keep texts as they are and put a space before them")
        own = [m.id_to_piece(i) for i in range(len(m)) if not (m.is_control(i) or m.is_byte(i) or m.is_unknown(i))]
        if any("▁" in p.lstrip("▁") for p in own):
            raise ValueError("a piece holds a space after another character")
        if any("\n" in p for p in own if len(p) > 1):
            raise ValueError("a longer piece holds a line end")
        runs = "|".join(f"[{re.escape(c)}]+" for c in _classes([p.lstrip("▁") for p in own]))
        self.find = re.compile(f" *(?:{runs}|[^ ])| +", re.DOTALL).findall
        self.lead = len(m.encode("\n"))

    def split(self, text: str | None) -> list[str]:
        """Pre-tokens of a text; the library puts a space before it."""
        return self.find(" " + text.replace("▁", " ")) if text else []

    def counts(self, pretokens: list[str]) -> list[int]:
        """How many pieces each has.  The line end before it keeps the library's own space away from it."""
        return [len(ids) - self.lead for ids in self.model.encode(["\n" + p for p in pretokens], num_threads=1)]


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


def name(pretoken: str) -> str:
    """The pre-token itself, or for a long one 128 bits (two signs in front, which no other pre-token has)."""
    return pretoken if len(pretoken) <= NAME else "\n\n" + hashlib.blake2b(pretoken.encode(), digest_size=16).hexdigest()


def _frequencies(path: str):
    def run(batches):
        split, seen = load(path).split, Counter()

        def flush():
            items = list(seen.items())
            for i in range(0, len(items), BATCH):
                some = items[i : i + BATCH]
                yield pa.RecordBatch.from_arrays([pa.array([name(p) for p, _ in some], pa.string()), pa.array([p if len(p) > NAME else None for p, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())], ["name", "pretoken", "n"])
            seen.clear()

        for batch in batches:
            for text in batch.column(0):
                seen.update(split(text.as_py()))
                if len(seen) > HELD:
                    yield from flush()
        yield from flush()

    return run


def _count(path: str):
    def run(batches):
        counts = load(path).counts
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts([long or short for short, long in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]), pa.int64())], ["name", "n", "pieces"])

    return run


def piece_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(name, n, pieces) of each distinct pre-token: how often it occurs and how many pieces it has; a table."""
    seen = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(_frequencies(path), "name string, pretoken string, n long")
    distinct = seen.groupBy("name").agg(F.max("pretoken").alias("pretoken"), F.sum("n").alias("n"))
    return cut(distinct.mapInArrow(_count(path), "name string, n long, pieces long"), "pieces")


def _sum(path: str, known, kept: list[str]):
    """Of each row: the sum over known pre-tokens, and its other ones with their frequencies."""

    def run(batches):
        split, task, at = load(path).split, TaskContext.get().partitionId(), 0
        pieces = known.value
        for batch in batches:
            sums, rest, found = [], [], pieces.get
            for text in batch.column(0):
                total, others = 0, []
                for p, n in Counter(split(text.as_py())).items():
                    p = name(p)
                    c = found(p)
                    if c is None:
                        others.append({"name": p, "n": n})
                    else:
                        total += c * n
                sums.append(total)
                rest.append(others)
            ids = pa.array(range((task << 40) + at, (task << 40) + at + len(sums)), pa.int64())
            at += len(sums)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], ids, pa.array(sums, pa.int64()), pa.array(rest, pa.list_(pa.struct([("name", pa.string()), ("n", pa.int64())])))], [*kept, "__row", "__known", "__rest"])

    return run


def token_counts(docs: DataFrame, path: str, text: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """docs without the text, with n_bytes (UTF-8) and n_tokens as the model at `path` counts them."""
    unfit(docs, ["n_bytes", "n_tokens", "__row", "__known", "__rest"])
    spark = docs.sparkSession
    prepare(spark)
    table = piece_counts(docs, path, text)
    most = table.orderBy(F.col("n").desc(), "name").limit(frequent).select("name", "pieces").toArrow()
    known = spark.sparkContext.broadcast(dict(zip(most.column(0).to_pylist(), most.column(1).to_pylist(), strict=True)))
    given = docs.select(F.col(text).cast("string").alias(text), *(F.col(f"`{c}`") for c in docs.columns if c != text), F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long").alias("n_bytes"))
    kept = given.columns[1:]
    schema = ", ".join([f"`{c}` {given.schema[c].dataType.simpleString()}" for c in kept] + ["__row long, __known long, __rest array<struct<name: string, n: bigint>>"])
    summed = cut(given.mapInArrow(_sum(path, known, kept), schema), "piece-sums")
    rest = summed.select("__row", F.explode("__rest").alias("r")).select("__row", "r.name", "r.n")
    rest = rest.join(table.select("name", "pieces"), "name").groupBy("__row").agg(F.sum(F.col("n") * F.col("pieces")).alias("__more"))
    out = summed.drop("__rest").join(rest, "__row", "left")
    return out.select(*(F.col(f"`{c}`") for c in kept), (F.col("__known") + F.coalesce("__more", F.lit(0))).alias("n_tokens"))


def query(spark, sf_dir: str, limit: int = 4096) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_counts(docs, public_tokenizers.path("piece_bpe_32k.model")).withColumn("over_limit", F.col("n_tokens") > limit)
