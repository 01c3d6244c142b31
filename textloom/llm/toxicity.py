"""Toxicity by nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes,
distance-weighted votes, calibrated, with the examples as evidence.

Sample.  Labelled rows with one text are one example whose label is their mean.  At most `per_class`
examples with a mean of 0.5 or more and as many others are taken, by a hash of the text.  Near copies
among them (Jaccard of five-word shingles 0.8 or more, counted exactly) are one example with the mean
of their labels: copies of one text would count as so many witnesses.

Terms are words (runs of ASCII letters and non-ASCII bytes, lower-cased) and their prefixes of 4 and 6
bytes: all that occur in the sample, no fewer.  A term's weight is (1 + log tf) x idf x (1 + marks):
idf is over all documents; marks is how far the term's counts in the sample speak for label 1 beyond
chance over all terms tried (log of an exact bound, less log(terms / alpha); 0 for most terms).

Search.  Terms of few examples have posting lists, summed for a batch of texts at once.  The `dense`
most frequent have a matrix in blocks of 64 examples with each term's largest weight in each block; a
block is multiplied only for texts whose bound in it, the largest sum of postings and the block's
largest weights, reaches the k-th best cosine so far.  That loses no neighbour.

The vote of the k nearest, weighted by cosine, is mapped to a probability by a monotone fit on
leave-one-out votes of the sample, weighted back to the labels' own rates.

Nulls are empty texts.  A text without any term of the sample has the rate of label 1 among such
examples.  Labels of no document, null, or other than 0 and 1 count for nothing.  Without examples of
both labels every score is the rate of label 1 (0 without labels).  Ties of cosine go in order of the
texts' hashes; doc_id decides nothing but is told as evidence (the least one with the example's text).
Columns of the given table that are called like new ones can't be kept: score() raises ValueError.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm import words as W
from textloom.llm.shared import cut, parts, prepare, text_key

PER_CLASS, NEIGHBOURS, ALPHA, ALIKE = 1000, 15, 0.01, 0.8
BLOCK, DENSE, BATCH, SLICE = 64, 1024, 256, 1 << 19
PREFIXES = (4, 6)
BREAKS = np.ones(256, bool)
BREAKS[97:123] = False
BREAKS[128:] = False


def bags(texts: pa.Array):
    """For slices of lower-cased texts: (text within the batch, word, count) of distinct words, and the words' term hashes (0: none)."""
    data, offsets = W.buffers(texts)
    for a, b in W.slices(offsets, SLICE):
        off = offsets[a : b + 1]
        part = data[off[0] : off[-1]]
        starts, ends, first = W.spans(part, off - off[0], BREAKS)
        words, at, inverse = np.unique(W.hashes(part, starts, ends), return_index=True, return_inverse=True)
        cell, tf = W.tally(np.repeat(np.arange(b - a), np.diff(first)) * max(len(words), 1) + inverse)
        terms = np.zeros((len(words), 1 + len(PREFIXES)), W.U)
        terms[:, 0] = words
        order = np.argsort(at)
        s, e = starts[at[order]], ends[at[order]]
        for i, n in enumerate(PREFIXES, 1):
            long = np.flatnonzero(e - s > n)
            terms[order[long], i] = W.mix(W.hashes(part, s[long], s[long] + n) ^ W.U(n))
        yield cell // max(len(words), 1) + a, cell % max(len(words), 1), tf, terms


@dataclass
class Terms:
    """The sample's terms: hashes in order, and each one's weight."""

    keys: np.ndarray
    weight: np.ndarray

    def cells(self, texts: pa.Array):
        """For each slice: (text, term, count) of known terms, sorted."""
        f = max(len(self.keys), 1)
        for who, word, tf, terms in bags(texts):
            at = np.searchsorted(self.keys, terms)
            known = (self.keys[np.minimum(at, f - 1)] == terms) & (terms != 0) if len(self.keys) else np.zeros(terms.shape, bool)
            has = known[word]
            col = at[word]
            cell, n = W.tally((who[:, None] * f + col)[has], np.broadcast_to(tf[:, None], has.shape)[has])
            yield cell // f, cell % f, n

    def vectors(self, texts: pa.Array):
        """For each slice: unit vectors as (text, term, weight), sorted; terms of weight 0 are left out."""
        for row, col, n in self.cells(texts):
            yield self.unit(row, col, n)

    def unit(self, row, col, n):
        w = (1 + np.log(n)) * self.weight[col]
        on = w > 0
        row, col, w = row[on], col[on], w[on]
        norm = np.sqrt(np.bincount(row, w * w)) if len(row) else np.empty(0)
        return row, col, w / norm[row] if len(row) else w


class Index:
    """Examples (in order of their hashes): postings of rare terms, and blocks of the frequent ones with largest weights."""

    def __init__(self, n: int, n_terms: int, row: np.ndarray, col: np.ndarray, w: np.ndarray):
        self.n, self.blocks = n, -(-n // BLOCK)
        frequent = np.argsort(-np.bincount(col, minlength=n_terms), kind="stable")[:DENSE]
        self.place = np.full(n_terms, -1, np.int32)
        self.place[frequent] = np.arange(len(frequent))
        dense = self.place[col] >= 0
        self.matrix = np.zeros((len(frequent), self.blocks * BLOCK))
        self.matrix[self.place[col[dense]], row[dense]] = w[dense]
        self.most = self.matrix.reshape(len(frequent), self.blocks, BLOCK).max(2, initial=0)
        row, col, w = row[~dense], col[~dense], w[~dense]
        order = np.lexsort((row, col))
        self.doc, self.w = row[order].astype(np.int32), w[order]
        self.offset = np.searchsorted(col[order], np.arange(n_terms + 1)).astype(np.int32)

    def nearest(self, row: np.ndarray, col: np.ndarray, w: np.ndarray, texts: int, k: int, but: np.ndarray | None = None, batch: int = BATCH):
        """(text, example, cosine) of the k examples of largest positive cosine of each text, nearest first.
        but: an example that a text must not find."""
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        for a in range(0, texts, batch):
            b = min(texts, a + batch)
            s, e = np.searchsorted(row, [a, b])
            if s < e:
                t, x, c = self._batch(row[s:e] - a, col[s:e], w[s:e], b - a, k, None if but is None else but[a:b])
                out.append((t + a, x, c))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def _batch(self, row, col, w, texts, k, but):
        width = self.blocks * BLOCK
        place = self.place[col]
        dense = place >= 0
        q = np.zeros((texts, len(self.matrix)))
        q[row[dense], place[dense]] = w[dense]
        row, col, w = row[~dense], col[~dense], w[~dense]
        start = self.offset[col]
        n = self.offset[col + 1] - start
        at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
        score = np.bincount(np.repeat(row, n) * width + self.doc[at], np.repeat(w, n) * self.w[at], texts * width).reshape(texts, width)
        if but is not None:
            score[np.arange(texts), but] = -1e9
        bound = score.reshape(texts, self.blocks, BLOCK).max(2) + q @ self.most + 1e-9
        best = bound.argmax(1)
        done = np.zeros(bound.shape, bool)
        for full in (False, True):  # first each text's best block, then all that can hold one of the k nearest
            kth = np.partition(score, width - k, 1)[:, width - k] if k < width else np.zeros(texts)
            for b in range(self.blocks):
                who = np.flatnonzero((bound[:, b] >= kth) & ~done[:, b] if full else best == b)
                if len(who):
                    done[who, b] = True
                    score[who, b * BLOCK : (b + 1) * BLOCK] += q[who] @ self.matrix[:, b * BLOCK : (b + 1) * BLOCK]
        score = np.round(score, 12)
        kth = np.partition(score, width - k, 1)[:, width - k] if k < width else np.zeros(texts)
        t, x = np.nonzero((score > 0) & (score >= kth[:, None]) & np.repeat(done, BLOCK, 1))
        c = score[t, x]
        order = np.lexsort((x, -c, t))
        t, x, c = t[order], x[order], c[order]
        keep = np.arange(len(t)) - np.searchsorted(t, t) < k
        return t[keep], x[keep], c[keep]


def votes(text: np.ndarray, example: np.ndarray, cosine: np.ndarray, label: np.ndarray, texts: int) -> np.ndarray:
    """The weighted part of label 1 among the nearest and one more of label 0; -1: none near.
    That one keeps a vote of far examples alone from being certain."""
    all_ = np.bincount(text, cosine, texts)
    return np.where(all_ > 0, np.bincount(text, cosine * label[example], texts) / (all_ + 1), -1.0)


def monotone(x: np.ndarray, y: np.ndarray, w: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the best increasing fit of y on x (pooled neighbours), each pool pulled a little to the prior."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for i in order:
        pools.append([w[i], w[i] * y[i], x[i], x[i], 1])
        while len(pools) > 1 and (pools[-2][3] == pools[-1][2] or pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]):
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3], pools[-1][4] + last[4]]
    xs, ys = [], []
    for a, b, lo, hi, n in pools:
        rate = (b / a * n + prior) / (n + 1)
        xs += [lo, hi]
        ys += [rate, rate]
    return np.array(xs), np.maximum.accumulate(np.array(ys)) if ys else np.array(ys)


def near_copies(shingles: list[np.ndarray]) -> np.ndarray:
    """For each example the first of its group; groups are joined by Jaccard of shingle sets of ALIKE or more."""
    n = len(shingles)
    root = np.arange(n)
    size = np.array([len(s) for s in shingles], np.int64)
    every = np.concatenate([np.empty(0, W.U), *shingles])
    _, inverse = np.unique(every, return_inverse=True)
    owner = np.repeat(np.arange(n), size)
    order = np.lexsort((owner, inverse))
    holder, first = owner[order], np.searchsorted(inverse[order], np.arange(inverse.max(initial=-1) + 2))
    begin = np.concatenate([[0], np.cumsum(size)])

    def top(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for i in range(n):
        own = inverse[begin[i] : begin[i + 1]]
        if not len(own):
            continue
        count = first[own + 1] - first[own]
        at = np.repeat(first[own] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        both = np.bincount(holder[at], minlength=n)
        for j in np.flatnonzero((both >= ALIKE * (size[i] + size - both)) & (both > 0)):
            a, b = top(i), top(j)
            root[max(a, b)] = min(a, b)
    return np.array([top(i) for i in range(n)], np.int64)


def marks(n: np.ndarray, k: np.ndarray, rate: float) -> np.ndarray:
    """-log of a bound on the chance of k or more of n at the rate (n KL(k/n || rate)), less log(terms tried / ALPHA); 0 at least."""
    p = k / n
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = n * (np.where(p > 0, p * np.log(p / rate), 0) + np.where(p < 1, (1 - p) * np.log((1 - p) / (1 - rate)), 0))
    return np.where(p > rate, np.maximum(gain - math.log(max(len(n), 1) / ALPHA), 0), 0)


@dataclass
class Scorer:
    terms: Terms
    index: Index
    label: np.ndarray
    ids: np.ndarray
    knots: tuple[np.ndarray, np.ndarray]
    none: float
    k: int

    def score(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Scores of lower-cased texts, and the doc_ids of the nearest examples."""
        out, found, n = np.full(len(texts), self.none), [(np.empty(0, np.int64),) * 2], len(texts)
        if len(self.knots[0]):
            for row, col, w in self.terms.vectors(texts):
                if len(row):
                    a, b = row[0], row[-1] + 1
                    t, x, c = self.index.nearest(row - a, col, w, b - a, self.k)
                    v = votes(t, x, c, self.label, b - a)
                    out[a:b] = np.where(v >= 0, np.interp(v, *self.knots), out[a:b])
                    found.append((t + a, self.ids[x]))
        t, ids = (np.concatenate(x) for x in zip(*found, strict=True))
        return out, pa.ListArray.from_arrays(pa.array(np.searchsorted(t, np.arange(n + 1)), pa.int32()), pa.array(ids))


def _examples(batches):
    """From (k1, k2, doc_id, y, text): those, with the shingles and the (term, count) pairs of the text as blobs."""
    for batch in batches:
        texts = batch.column(4)
        data, offsets = W.buffers(texts)
        out = []
        for i in range(len(offsets) - 1):
            x, _ = W.shingles(*W.words(data[offsets[i] : offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]])), 5)
            keys, tf = np.empty(0, W.U), np.empty(0, np.int64)
            for _, word, n, terms in bags(texts.slice(i, 1)):
                has = terms[word] != 0
                keys, tf = W.tally(terms[word][has], np.broadcast_to(n[:, None], has.shape)[has])
            out.append((np.unique(x).tobytes(), keys.tobytes(), tf.astype(np.int32).tobytes()))
        blobs = [pa.array([r[j] for r in out], pa.binary()) for j in range(3)]
        yield pa.RecordBatch.from_arrays([*(batch.column(j) for j in range(4)), *blobs], ["k1", "k2", "doc_id", "y", "shingles", "terms", "tf"])


def sample_of(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[list[dict], list[int]]:
    """The examples, in order of their texts' hashes, and how many distinct labelled texts there are of either label."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
    text = F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_key(text)).join(known, "doc_id")
    each = cut(labelled.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id"), F.avg("toxic").alias("y")), "toxic-labelled")
    counts = {r.c: r["count"] for r in each.groupBy((F.col("y") >= 0.5).cast("int").alias("c")).count().collect()}
    pick = None
    for some in (each.filter("y < 0.5"), each.filter("y >= 0.5")):
        some = some.orderBy("k1", "k2").limit(per_class)
        pick = some if pick is None else pick.unionByName(some)
    pick = cut(pick, "toxic-picked")
    found = docs.select(text.alias("text")).select(*text_key(F.col("text")), "text").join(F.broadcast(pick), ["k1", "k2"])  # bounded by 2 per_class rows
    found = found.groupBy("k1", "k2").agg(*(F.first(c).alias(c) for c in ("doc_id", "y", "text")))
    rows = found.mapInArrow(_examples, "k1 long, k2 long, doc_id long, y double, shingles binary, terms binary, tf binary").toArrow().to_pylist()  # bounded by 2 per_class rows
    return sorted(rows, key=lambda r: (r["k1"], r["k2"])), [counts.get(0, 0), counts.get(1, 0)]


def frequencies(docs: DataFrame, keys: np.ndarray) -> tuple[int, np.ndarray]:
    """The number of documents, and of those that hold each term."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(keys)  # bounded by the texts of 2 per_class rows

    def count(batches):
        terms, total, docs_ = Terms(held.value, np.empty(0)), np.zeros(len(held.value), np.int64), 0
        for batch in batches:
            docs_ += batch.num_rows
            for _, col, _ in terms.cells(batch.column(0)):
                total += np.bincount(col, minlength=len(total))
        some = np.flatnonzero(total)
        col, n = np.append(some, -1), np.append(total[some], docs_)
        for i in range(0, len(col), 1 << 14):
            yield pa.RecordBatch.from_arrays([pa.array(col[i : i + (1 << 14)].astype(np.int32)), pa.array(n[i : i + (1 << 14)])], ["term", "n"])

    text = F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    got = docs.select(text.alias("text")).mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # a row for each term of the sample
    term, n = got.column("term").to_numpy(), got.column("n").to_numpy()
    out = np.zeros(len(keys), np.int64)
    out[term[term >= 0]] = n[term >= 0]
    return int(n[term < 0].sum()), out


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, k: int = NEIGHBOURS) -> Scorer:
    """Learn from labels (doc_id, toxic) of docs (doc_id, text)."""
    prepare(docs.sparkSession)
    rows, counts = sample_of(docs, labels, per_class)
    prior = counts[1] / max(1, sum(counts))
    root = near_copies([np.frombuffer(r["shingles"], W.U) for r in rows])
    y = np.array([r["y"] for r in rows], float)
    first = np.unique(root)
    y = (np.bincount(root, y, len(rows)) / np.maximum(np.bincount(root, minlength=len(rows)), 1))[first] if len(rows) else y
    rows = [rows[i] for i in first]
    ids = np.array([r["doc_id"] for r in rows], np.int64)
    have = [float((1 - y).sum()), float(y.sum())]
    nothing = Terms(np.empty(0, W.U), np.empty(0))
    if not all(have):
        none = np.empty(0, np.int64)
        return Scorer(nothing, Index(0, 0, none, none, np.empty(0)), y, ids, (np.empty(0), np.empty(0)), prior, k)
    of = [np.frombuffer(r["terms"], W.U) for r in rows]
    keys, col = np.unique(np.concatenate(of), return_inverse=True)
    row = np.repeat(np.arange(len(rows)), [len(x) for x in of])
    tf = np.concatenate([np.frombuffer(r["tf"], np.int32) for r in rows])
    del rows, of
    total, df = frequencies(docs, keys)
    speaks = marks(np.bincount(col, minlength=len(keys)), np.bincount(col, y[row], len(keys)), have[1] / len(ids))
    terms = Terms(keys, np.log((1 + total) / (1 + df)) * (1 + speaks))
    row, col, w = terms.unit(row, col, tf)
    index = Index(len(ids), len(keys), row, col, w)
    order = np.lexsort((col, row))
    got = index.nearest(row[order], col[order], w[order], len(ids), k, np.arange(len(ids)), 32)
    vote = votes(*got, y, len(ids))
    share = [counts[c] / have[c] for c in (0, 1)]
    weight = share[1] * y + share[0] * (1 - y)
    ok = vote >= 0
    none = ((weight * y)[~ok].sum() + prior) / (weight[~ok].sum() + 1)
    return Scorer(terms, index, y, ids, monotone(vote[ok], y[ok], weight[ok], prior), float(min(none, 1.0)), k)


def score(docs: DataFrame, scorer: Scorer, keep: list[Column], text: str = "text") -> DataFrame:
    """The columns keep, then score, predicted and evidence (doc_ids of the nearest examples, nearest first)."""
    prepare(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(scorer)  # bounded by the texts of 2 per_class rows

    def run(batches):
        s = held.value
        for batch in batches:
            p, who = s.score(batch.column(0))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(p), pa.array((p >= 0.5).astype(np.int32)), who], [*names, "score", "predicted", "evidence"])

    kept = docs.select(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("__text"), *keep)
    names = kept.columns[1:]
    if len({*names, "__text", "score", "predicted", "evidence"}) < len(names) + 4:
        raise ValueError(f"columns called twice, or like new ones: {names}")
    schema = ", ".join([f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in names] + ["score double", "predicted int", "evidence array<long>"])
    return kept.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Whether labels of a document are never learned: crc32(doc_id as text) mod 5 is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def learned(docs: DataFrame, sf_dir: str) -> Scorer:
    labels = docs.sparkSession.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out(F.col("doc_id")))
    return fit(docs, labels)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = score(docs, learned(docs, sf_dir), [F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out")])
    return out.select("doc_id", "held_out", "score", "predicted", "evidence")


def clean(docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that aren't predicted toxic, with their own columns."""
    row = F.struct(*(F.col(c) for c in docs.columns)).alias("row")
    return score(docs, learned(docs, sf_dir), [row]).filter("predicted = 0").select("row.*")
