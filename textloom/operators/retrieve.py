"""Search: BM25 over postings, exact nearest vectors in blocks, rank fusion.  Many queries at once.

Scores are compared after rounding to 6 places (fused ones to 12), ties by key.  Sums don't depend on
their order, so that equal texts and equal vectors have equal scores to the last bit: at 12 places
rounding alone would tell them apart now and then.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.functions import text as T
from textloom.functions import vectors as V
from textloom.operators.lineage import place, small_batches, stored

K1, B, EPSILON = 1.5, 0.75, 0.25
BLOCK = 1024


@dataclass
class Index:
    """A stored BM25 index below path.

    blocks   (term, range, n, max_tf, min_len, keys, tfs, lens): a term's postings among RANGE documents or so, with
             the largest frequency and the least length among them, which bound what any of them can score
    lengths  (doc_key, len)
    terms    (term, df, raw): raw = ln(N - df + 0.5) - ln(df + 0.5)
    and of all documents their number, mean length and the terms' mean raw."""

    path: str
    blocks: DataFrame
    lengths: DataFrame
    raw: DataFrame
    n_docs: int
    n_ranges: int
    avgdl: float
    mean_raw: float
    tokenizer: str = "simple"

    @property
    def terms(self) -> DataFrame:
        """(term, df, idf): where raw is below zero, idf is a quarter of its mean."""
        return self.raw.select("term", "df", F.when(F.col("raw") < 0, F.lit(EPSILON * self.mean_raw)).otherwise(F.col("raw")).alias("idf"))


RANGE, WIDE = 512, 64
FEW = 200_000  # asked terms that are broadcast, some 10 MB
CELLS, KEPT = 1 << 22, 1 << 19  # scores of a range that are held at once; best rows that a task holds
WORD = bytes(c if chr(c).isalnum() and c < 128 else 32 for c in range(256))  # all bytes but those of tokens are spaces


def exact_sum(x: Column) -> Column:
    """The sum of doubles at 12 places, the same in any order; for sums below a million."""
    return F.sum(F.round(x * F.lit(1e12)).cast("long")) / F.lit(1e12)


def term_counts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("doc_key"), F.explode(T.tokenize(text)).alias("term")).groupBy("doc_key", "term").agg(F.count("*").alias("tf"))


def _segment(docs: DataFrame, key: str, text: str, postings: DataFrame | None, path: str, first: int, mode: str, analyzer: Callable[[], Callable[[dict], dict]] | None = None) -> int:
    """Writes blocks and lengths of documents with distinct keys, their ranges counted from `first`; how many ranges."""
    ranges = max(1, -(-docs.count() // RANGE))
    span = F.pmod(F.xxhash64("doc_key"), F.lit(ranges)) + F.lit(first)
    small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    if postings is None:
        counted = docs.select(F.col(key).alias("doc_key"), F.lower(T.safe(text)).alias("text")).mapInArrow(_counted(analyzer), f"doc_key {kind}, len int, terms binary, tfs binary")
        counted = stored(counted.select(span.cast("int").alias("range"), "*"), "counted")
        counted.select("doc_key", "len").write.mode(mode).parquet(f"{path}/lengths")
        # one shuffle, a row for each document: a range is bounded, so a frequent term is many places' work
        placed = counted.repartition("range").sortWithinPartitions("range")
        blocks = placed.mapInArrow(_packed, f"term string, range int, n int, max_tf int, min_len int, keys array<{kind}>, tfs array<int>, lens array<int>")
        blocks.write.mode(mode).parquet(f"{path}/blocks")
        return ranges
    lengths = docs.select(F.col(key).alias("doc_key")).join(postings.groupBy("doc_key").agg(F.sum("tf").alias("len")), "doc_key", "left").select("doc_key", F.coalesce("len", F.lit(0)).cast("int").alias("len"))
    each = postings.join(lengths, "doc_key").select("doc_key", "len", "term", F.col("tf").cast("int").alias("tf"))
    lengths.write.mode(mode).parquet(f"{path}/lengths")
    placed = each.withColumn("range", span.cast("int")).repartition("range")
    rows = placed.groupBy("term", "range").agg(F.collect_list(F.struct("doc_key", "tf", "len")).alias("p"))
    field = lambda name: F.transform("p", lambda x: x[name])
    blocks = rows.select("term", "range", F.size("p").alias("n"), F.array_max(field("tf")).alias("max_tf"), F.array_min(field("len")).alias("min_len"), field("doc_key").alias("keys"), field("tf").alias("tfs"), field("len").alias("lens"))
    blocks.sortWithinPartitions("range", "term").write.mode(mode).parquet(f"{path}/blocks")
    return ranges


def _counted(analyzer: Callable[[], Callable[[dict], dict]] | None):
    """Rows (doc_key, lower-case text) with their length in terms, distinct terms and frequencies; an analyzer makes terms' frequencies of words'."""

    def run(batches):
        analyzed = analyzer() if analyzer else None
        for batch in batches:
            lens, terms, tfs = [], [], []
            for t in batch.column(1).to_pylist():
                n = Counter(t.encode().translate(WORD).split())
                n = analyzed(n) if analyzed else n
                lens.append(sum(n.values()))
                terms.append(b" ".join(n))
                tfs.append(np.fromiter(n.values(), "<i4", len(n)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lens, pa.int32()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())], ["doc_key", "len", "terms", "tfs"])

    return run


def _by_range(batches):
    """Rows sorted by range as (range, table of its rows)."""
    held, at = [], None
    for batch in batches:
        ranges = np.asarray(batch.column("range"))
        starts = np.r_[0, np.flatnonzero(np.diff(ranges)) + 1] if len(ranges) else []
        for i, j in zip(starts, np.r_[starts[1:], len(ranges)] if len(ranges) else []):
            if held and ranges[i] != at:
                yield at, pa.Table.from_batches(held)
                held = []
            at = int(ranges[i])
            held.append(batch.slice(int(i), int(j - i)))
    if held:
        yield at, pa.Table.from_batches(held)


def _starts(sizes):
    return np.r_[0, np.cumsum(sizes)]


def _packed(batches):
    """Counted documents sorted by range as the blocks of each range, by term."""
    for at, docs in _by_range(batches):
        words = [t.split() for t in docs.column("terms").to_pylist()]
        if not (n := sum(map(len, words))):
            continue
        doc = np.repeat(np.arange(len(words)), [len(w) for w in words])
        coded = pa.array((w for ws in words for w in ws), pa.binary(), size=n).dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        term = place[coded.indices.to_numpy()]
        by = np.argsort(term, kind="stable")
        doc, tf = doc[by], np.frombuffer(b"".join(docs.column("tfs").to_pylist()), "<i4")[by]
        length, starts = docs.column("len").to_numpy()[doc], np.searchsorted(term[by], np.arange(len(order) + 1))
        lists = lambda values, starts=starts: pa.ListArray.from_arrays(pa.array(starts, pa.int32()), values)
        keys = docs.column("doc_key").combine_chunks().take(pa.array(doc))
        one = lambda x: pa.array(x, pa.int32())
        columns = [coded.dictionary.take(pa.array(order)).cast(pa.string()), one(np.full(len(order), at)), one(np.diff(starts)), one(np.maximum.reduceat(tf, starts[:-1])), one(np.minimum.reduceat(length, starts[:-1])), lists(keys), lists(one(tf)), lists(one(length))]
        yield pa.RecordBatch.from_arrays(columns, ["term", "range", "n", "max_tf", "min_len", "keys", "tfs", "lens"])


def _totals(spark, path: str, ranges: int, tokenizer: str) -> Index:
    """Frequencies and means of all that the index holds, written anew, and the index."""
    docs = spark.read.parquet(f"{path}/lengths").agg(F.count("*").alias("n"), F.avg("len").alias("avgdl")).first()
    df = spark.read.parquet(f"{path}/blocks").groupBy("term").agg(F.sum("n").alias("df"))
    n = F.lit(docs.n)
    df.select("term", "df", (F.log(n - F.col("df") + F.lit(0.5)) - F.log(F.col("df") + F.lit(0.5))).alias("raw")).write.mode("overwrite").parquet(f"{path}/terms")
    mean = spark.read.parquet(f"{path}/terms").agg((F.sum(F.col("raw").cast("decimal(28,18)")) / F.count("raw")).cast("double").alias("m")).first().m
    spark.createDataFrame([(docs.n, ranges, docs.avgdl, mean, tokenizer)], "n_docs long, n_ranges int, avgdl double, mean_raw double, tokenizer string").coalesce(1).write.mode("overwrite").parquet(f"{path}/totals")
    return load_index(spark, path, tokenizer)


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", postings: DataFrame | None = None, tokenizer: str = "simple", path: str | None = None, analyzer: Callable[[], Callable[[dict], dict]] | None = None) -> Index:
    """Writes the index of documents with distinct keys below path (by default in the shared folder, for this
    application) and loads it.  postings (doc_key, term, tf): counts made by another tokenizer, which is named.  analyzer: makes, in each
    task, what turns a document's frequencies of words into those of terms, so that no token is shuffled; it is named as well."""
    path = path or place(docs.sparkSession, "bm25")
    ranges = _segment(docs, key, text, postings, path, 0, "overwrite", analyzer)
    return _totals(docs.sparkSession, path, ranges, tokenizer)


def add_documents(index: Index, docs: DataFrame, key: str = "doc_id", text: str = "text", postings: DataFrame | None = None) -> Index:
    """The index with more documents, whose keys it doesn't have yet: their blocks are added, frequencies and means made anew."""
    ranges = _segment(docs, key, text, postings, index.path, index.n_ranges, "append")
    return _totals(docs.sparkSession, index.path, index.n_ranges + ranges, index.tokenizer)


def save_index(index: Index, path: str) -> None:
    """A copy of the tables below another path."""
    spark = index.blocks.sparkSession
    for name in ("blocks", "lengths", "terms", "totals"):
        spark.read.parquet(f"{index.path}/{name}").write.mode("overwrite").parquet(f"{path}/{name}")


def load_index(spark, path: str, tokenizer: str = "simple") -> Index:
    t = spark.read.parquet(f"{path}/totals").first()
    if t.tokenizer != tokenizer:
        raise ValueError(f"the index was built by tokenizer {t.tokenizer!r}, not {tokenizer!r}")
    return Index(path, *(spark.read.parquet(f"{path}/{n}") for n in ("blocks", "lengths", "terms")), t.n_docs, t.n_ranges, t.avgdl or 0.0, t.mean_raw or 0.0, tokenizer)


def top(rows: DataFrame, k: int, score: str = "score", places: int = 6, key: str = "doc_key", group: str = "query_id") -> DataFrame:
    """The k best rows of each group with a rank from 1."""
    w = Window.partitionBy(group).orderBy(F.round(score, places).desc(), key)
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _part(index: Index, tf: Column, length: Column) -> Column:
    """What a term of a document adds to the score of a query."""
    tf = tf.cast("double")
    return F.col("times") * F.col("idf") * tf * F.lit(K1 + 1) / (tf + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * length / F.lit(index.avgdl)))


def _scored(index: Index, meeting: DataFrame) -> DataFrame:
    """(query_id, doc_key, score) of blocks that meet weighted terms."""
    hits = meeting.select("query_id", "times", "idf", F.inline(F.arrays_zip(F.col("keys").alias("doc_key"), F.col("tfs").alias("tf"), F.col("lens").alias("len"))))
    return hits.groupBy("query_id", "doc_key").agg(exact_sum(_part(index, F.col("tf"), F.col("len"))).alias("score"))


def _best(avgdl: float, k: int):
    """Blocks sorted by range beside the queries that ask their term (asking, weights): each query's k best documents over
    all the ranges of a task.  A range's scores are summed as longs at 12 places, in any order, and compared at 6."""

    def run(batches):
        held: dict = {}  # query: (-score at 6 places, key, score at 12 places), best first

        def flat(table, name):
            column = table.column(name).combine_chunks()
            return column.flatten(), _starts(pc.list_value_length(column).to_numpy())

        kinds = None
        for _, table in _by_range(batches):
            (keys, at), (tfs, _), (lens, _) = (flat(table, n) for n in ("keys", "tfs", "lens"))
            (asking, asked_at), (weights, _) = flat(table, "asking"), flat(table, "weights")
            kinds = asking.type, keys.type
            docs, queries = keys.dictionary_encode(), asking.dictionary_encode()
            order = pc.sort_indices(docs.dictionary).to_numpy()
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            doc, query, names = place[docs.indices.to_numpy()], queries.indices.to_numpy(), queries.dictionary.to_pylist()
            name = docs.dictionary.take(pa.array(order)).to_pylist()
            tf, length, w = tfs.to_numpy().astype(np.float64), lens.to_numpy().astype(np.float64), weights.to_numpy()
            under = tf + K1 * ((1 - B) + B * length / avgdl)
            step = max(1, CELLS // len(name))
            for low in range(0, len(names), step):
                score = np.zeros((min(step, len(names) - low), len(name)), np.int64)
                hit = np.zeros(score.shape, bool)
                for i, j, x, y in zip(at[:-1], at[1:], asked_at[:-1], asked_at[1:], strict=True):
                    q, v = query[x:y] - low, w[x:y]
                    if len(names) > step:
                        mine = (q >= 0) & (q < len(score))
                        q, v = q[mine], v[mine]
                    cell = np.ix_(q, doc[i:j])
                    score[cell] += np.floor(np.multiply.outer(v, tf[i:j]) * (K1 + 1) / under[i:j] * 1e12 + 0.5).astype(np.int64)
                    hit[cell] = True
                shown = np.sign(score) * ((np.abs(score) + 500_000) // 1_000_000)
                for n in range(len(score)):
                    have = held.setdefault(names[low + n], [])
                    fit = np.flatnonzero(hit[n] if len(have) < k else hit[n] & (shown[n] >= -have[-1][0]))
                    if len(fit) > k:
                        fit = fit[np.argsort(-shown[n, fit], kind="stable")[:k]]  # documents are in order of key
                    if len(fit):
                        have += [(-int(shown[n, m]), name[m], int(score[n, m])) for m in fit]
                        have.sort()
                        del have[k:]
        if kinds:
            rows = [(q, key, s / 1e12) for q, have in held.items() for _, key, s in have]
            for i in range(0, len(rows), 1 << 16):
                part = list(zip(*rows[i : i + (1 << 16)], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(part[0], kinds[0]), pa.array(part[1], kinds[1]), pa.array(part[2], pa.float64())], ["query_id", "doc_key", "score"])

    return run


def _best_of_ranges(index: Index, weighted: DataFrame, k: int) -> DataFrame:
    """(query_id, doc_key, score) with each query's k best among the rows: the blocks of asked terms are dealt by range, so a
    document's scores are summed where they meet and only k rows of a query leave a task.  Asked terms, a stored
    table, are sent to the blocks; many queries take their turn in parts."""
    small_batches(index.blocks.sparkSession)
    n = weighted.agg(F.count("*").alias("terms"), F.count_distinct("query_id").alias("queries")).first()
    parts = max(1, -(-n.terms // FEW), -(-n.queries * k // KEPT))
    kinds = [d.schema[c].dataType for d, c in ((weighted, "query_id"), (index.lengths, "doc_key"))]
    out = None
    for i in range(parts):
        mine = weighted.filter(F.pmod(F.xxhash64("query_id"), F.lit(parts)) == i) if parts > 1 else weighted
        asking = F.broadcast(mine.groupBy("term").agg(F.collect_list(F.struct("query_id", (F.col("times") * F.col("idf")).alias("w"))).alias("a")).select("term", F.col("a.query_id").alias("asking"), F.col("a.w").alias("weights")))  # FEW at most
        blocks = index.blocks.select("term", "range", "keys", "tfs", "lens").join(F.broadcast(mine.select("term").distinct()), "term", "left_semi").repartition("range")
        met = blocks.join(asking, "term").select("range", "keys", "tfs", "lens", "asking", "weights").sortWithinPartitions("range")
        found = met.mapInArrow(_best(index.avgdl, k), f"query_id {kinds[0].simpleString()}, doc_key {kinds[1].simpleString()}, score double")
        out = found if out is None else out.unionByName(found)
    return out


def _meet(index: Index, weighted: DataFrame, pairs: DataFrame) -> DataFrame:
    """Blocks beside the terms of the queries that read their range, by pairs (query_id, range), a stored table.  Few
    pairs and terms are sent to the blocks; else the blocks are joined by term and range."""
    if pairs.count() <= FEW and weighted.count() <= FEW:
        return index.blocks.join(F.broadcast(weighted), "term").join(F.broadcast(pairs), ["query_id", "range"])
    return index.blocks.join(weighted.join(pairs, "query_id"), ["term", "range"])


def reachable(index: Index, weighted: DataFrame, k: int, first: int = 2) -> tuple[DataFrame, DataFrame]:
    """(scores of the ranges read first, (query_id, range) that must be read besides) for the k best of each query.

    A range's bound for a query is the sum over its terms of what their largest frequency and least length in it
    would score.  The `first` ranges of the highest bounds are scored; a query's k-th best score there is what
    another range's bound must reach, or no bar where there are fewer than k."""
    bounds = index.blocks.select("term", "range", "max_tf", "min_len").join(weighted, "term")
    bounds = bounds.groupBy("query_id", "range").agg(F.sum(F.greatest(_part(index, F.col("max_tf"), F.col("min_len")), F.lit(0.0))).alias("bound"))
    w = Window.partitionBy("query_id").orderBy(F.col("bound").desc(), "range")
    bounds = stored(bounds.withColumn("place", F.row_number().over(w)), "bounds")
    early = bounds.filter(F.col("place") <= first).select("query_id", "range")
    scores = stored(_scored(index, _meet(index, weighted, early)), "first-scores")
    bar = top(scores, k).filter(F.col("rank") == k).select("query_id", F.col("score").alias("bar"))
    rest = bounds.filter(F.col("place") > first).join(bar, "query_id", "left").filter(F.col("bar").isNull() | (F.col("bound") >= F.col("bar") - F.lit(1e-5)))
    return scores, stored(rest.select("query_id", "range"), "ranges")


def weighted_terms(index: Index, queries: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """(query_id, term, times, idf) of queries (query_id, text) or of their terms, stored and counted: up to FEW rows
    are sent to the blocks, which then stay where they are; more are joined with them by term."""
    asked = (queries.select("query_id", F.explode(T.tokenize("text")).alias("term")) if terms is None else terms).groupBy("query_id", "term").agg(F.count("*").alias("times"))
    weighted = stored(asked.join(index.terms.select("term", "idf"), "term"), "asked")
    return F.broadcast(weighted) if weighted.count() <= FEW else weighted


def bm25(index: Index, queries: DataFrame, k: int, fill: bool = False, terms: DataFrame | None = None, bounded: bool | None = None) -> DataFrame:
    """(query_id, doc_key, score, rank) of queries (query_id, text).  A term counts as often as the query holds it.
    fill: queries with fewer than k matches also get documents of score 0, in order of key.
    bounded: read only ranges that can reach a query's k best, which takes two more passes over the asked terms'
    bounds.  By default an index of WIDE ranges or more is read range by range, each task keeping a query's best.
    The rows are the same."""
    weighted = weighted_terms(index, queries, terms)
    if bounded:
        early, rest = reachable(index, weighted, k)
        scored = early.unionByName(_scored(index, _meet(index, weighted, rest)))
    elif bounded is None and index.n_ranges >= WIDE:
        scored = _best_of_ranges(index, weighted, k)
        scored = stored(scored, "scored") if fill else scored
    else:
        scored = _scored(index, index.blocks.join(weighted, "term"))
    if fill:
        short = scored.groupBy("query_id").agg(F.count("*").alias("n"))
        short = queries.select("query_id").join(short, "query_id", "left").filter(F.coalesce("n", F.lit(0)) < k).select("query_id")
        some = index.lengths.orderBy("doc_key").limit(2 * k).select("doc_key")  # bounded by k
        zero = short.join(F.broadcast(some)).join(scored, ["query_id", "doc_key"], "left_anti").withColumn("score", F.lit(0.0))
        scored = scored.unionByName(zero)
    return top(scored, k).select("query_id", "doc_key", "score", "rank")


def _blocks(name: str):
    """Rows (key, v) as blocks of at most BLOCK rows of one length."""

    def run(batches):
        for batch in batches:
            lengths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths).tolist():
                whole = batch.take(pa.array(np.flatnonzero(lengths == dim)))
                for i in range(0, whole.num_rows, BLOCK):
                    part = whole.slice(i, BLOCK)
                    yield pa.RecordBatch.from_arrays([pa.array([part.column(0).to_pylist()], pa.list_(part.column(0).type)), pa.array([np.array(part.column(1).to_pylist(), np.float64).tobytes()], pa.binary()), pa.array([dim], pa.int32())], [f"{name}_keys", f"{name}_matrix", "dim"])

    return run


MOST_CELLS, HELD = 144, 32
MOST_SIDE, PAIRS, SLACK = 16, 1 << 20, 1e-4  # of alike(): sides of its grid, found pairs held before the best are taken, and for single precision


def grid(n_queries: int, n_rows: int, partitions: int) -> tuple[int, int]:
    """Rows and columns of the grid that copies least: queries go to every column, the rows searched to every row.  Its
    cells are bounded, so that what is shuffled grows as the input does."""
    cells = max(1, min(partitions, MOST_CELLS))
    rows = min(cells, max(1, round(math.sqrt(cells * max(n_queries, 1) / max(n_rows, 1)))))
    return rows, -(-cells // rows)


def alike(rows: DataFrame, k: int, least: float) -> DataFrame:
    """(query_id, doc_key, score, rank): for each of rows (doc_key, v: usable), a stored table, the k rows, itself among them, with the largest dot
    product, as in nearest(), but only those of `least` or more.  All pairs of blocks are multiplied, each once: cells of a bounded grid
    hold two parts of the blocks and take both directions; a task keeps each row's k best of a cell.  Products are made in
    single precision, and those within SLACK of the bar anew in double."""
    spark = rows.sparkSession
    small_batches(spark)
    kind = rows.schema["doc_key"].dataType.simpleString()
    side = max(1, min(MOST_SIDE, math.isqrt(2 * int(spark.conf.get("spark.sql.shuffle.partitions"))), rows.count() // (2 * BLOCK)))
    made = rows.select("doc_key", "v").mapInArrow(_blocks("d"), f"d_keys array<{kind}>, d_matrix binary, dim int").withColumn("part", F.pmod(F.xxhash64("d_keys"), F.lit(side)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(side - 1)))
    cells = made.withColumn("other", every).select((F.least("part", "other") * side + F.greatest("part", "other")).alias("cell"), F.signum(F.col("other") - F.col("part")).cast("int").alias("turn"), "d_keys", "d_matrix", "dim")
    cells = cells.repartition(side * side, "cell").sortWithinPartitions("cell", F.desc("turn"))  # the part of a lower number is held
    bar = round(least, 6) - 1e-6

    def near(batches):
        now, found, many = None, [], 0

        def best():
            q, d, score = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((d, -np.round(score, 6), q))
            starts = np.flatnonzero(np.r_[True, q[order][1:] != q[order][:-1]])[: len(order)]
            fit = order[np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)])) < k]
            found[:] = [(q[fit], d[fit], score[fit])]
            return len(fit)

        def out():
            if found:
                best()
                q, d, score = found.pop()
                for i in range(0, len(q), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(q[i : i + (1 << 16)].tolist(), of), pa.array(d[i : i + (1 << 16)].tolist(), of), pa.array(score[i : i + (1 << 16)])], ["query_id", "doc_key", "score"])

        for batch in batches:
            of = batch.schema.field("d_keys").type.value_type
            for i in range(batch.num_rows):
                if (cell := batch.column("cell")[i].as_py()) != now:
                    yield from out()
                    now, held, many, most = cell, [], 0, PAIRS
                keys, dim, turn = np.array(batch.column("d_keys")[i].as_py()), batch.column("dim")[i].as_py(), batch.column("turn")[i].as_py()
                x = np.frombuffer(batch.column("d_matrix")[i].as_py()).reshape(len(keys), -1)
                small = x.astype(np.float32)
                if turn >= 0:
                    held.append((keys, x, small, dim))
                if turn > 0:
                    continue
                for n, (others, y, less, d) in enumerate(held):
                    if d != dim:
                        continue
                    a, b = np.divmod(np.flatnonzero(small @ less.T >= bar - SLACK), len(others))
                    for j in range(0, len(a), 1 << 16):
                        p, q = a[j : j + (1 << 16)], b[j : j + (1 << 16)]
                        score = (x[p] * y[q]).sum(1)
                        fit = np.round(score, 6) >= bar
                        one, two, score = keys[p[fit]], others[q[fit]], score[fit]
                        found.append((one, two, score))
                        if turn < 0 or n < len(held) - 1:  # a block with itself has both directions
                            found.append((two, one, score))
                        many += 2 * len(score)
                    if many > most:
                        many = best()
                        most = many + PAIRS
        yield from out()

    pairs = cells.mapInArrow(near, f"query_id {kind}, doc_key {kind}, score double")
    return top(pairs, k).select("query_id", "doc_key", "score", "rank")


def nearest(queries: DataFrame, corpus: DataFrame, k: int, skip_self: bool = False, metric: str = "dot", slots: int | None = None) -> DataFrame:
    """(query_id, doc_key, score, rank): the k rows of corpus (doc_key, v) with the largest dot product
    (metric l2: the least distance, as its negative) for each query (query_id, v).  Exact.  Blocks of both
    sides are multiplied as matrices; a task keeps each query's k best of a cell, merged by a window.  A grid of about as many
    cells as partitions, MOST_CELLS at most, holds the pairs of blocks: a block is copied along its row or column, the larger side's
    less often; neither side is collected or broadcast.  Vectors of different lengths don't meet; a vector
    that is null, empty or holds null or non-finite components is no neighbour and has none."""
    small_batches(queries.sparkSession)
    rows, cols = (slots, slots) if slots else grid(queries.count(), corpus.count(), int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    kinds = queries.schema["query_id"].dataType.simpleString(), corpus.schema["doc_key"].dataType.simpleString()
    q = queries.filter(V.usable("v")).select("query_id", F.col("v").cast("array<double>")).mapInArrow(_blocks("q"), f"q_keys array<{kinds[0]}>, q_matrix binary, dim int")
    d = corpus.filter(V.usable("v")).select("doc_key", F.col("v").cast("array<double>")).mapInArrow(_blocks("d"), f"d_keys array<{kinds[1]}>, d_matrix binary, dim int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = q.withColumn("row", F.pmod(F.xxhash64("q_keys"), F.lit(rows)).cast("int")).withColumn("col", every(cols))
    d = d.withColumn("col", F.pmod(F.xxhash64("d_keys"), F.lit(cols)).cast("int")).withColumn("row", every(rows))

    def best(batches):
        blocks: dict = {}  # of a block of queries and all its pairs so far, each query's k best: (shown, key, score)

        def out(asked):
            shown, keys, score = blocks.pop(asked)
            ok = shown > -np.inf
            rows = np.flatnonzero(ok) // max(1, shown.shape[1])
            return pa.RecordBatch.from_arrays([pa.array(asked, q_kind).take(pa.array(rows)), pa.array(keys[ok].tolist(), d_kind), pa.array(score[ok])], ["query_id", "doc_key", "score"])

        for batch in batches:
            q_kind, d_kind = (batch.schema.field(n).type.value_type for n in ("q_keys", "d_keys"))
            for n in range(batch.num_rows):
                r = batch.slice(n, 1)
                mine, d_keys = tuple(r.column("q_keys").flatten().to_pylist()), np.array(r.column("d_keys").flatten().to_pylist())
                if not len(mine) or not len(d_keys):
                    continue
                if mine not in blocks and len(blocks) == HELD:
                    yield out(next(iter(blocks)))
                held = blocks.get(mine) or (np.full((len(mine), 0), -np.inf), np.empty((len(mine), 0), d_keys.dtype), np.empty((len(mine), 0)))
                a, b = np.frombuffer(r.column("q_matrix")[0].as_py()).reshape(len(mine), -1), np.frombuffer(r.column("d_matrix")[0].as_py()).reshape(len(d_keys), -1)
                shown = np.round(a @ b.T if metric == "dot" else 2 * a @ b.T - (a * a).sum(1)[:, None] - (b * b).sum(1), 6)
                if skip_self:
                    shown[np.array(mine)[:, None] == d_keys] = -np.inf
                bar = held[0][:, -1:] if held[0].shape[1] == k else np.full((len(a), 1), -np.inf)
                fit = (shown >= bar) & (shown > -np.inf)
                most = int(fit.sum(1).max(initial=0))
                if not most:
                    continue
                if most > k:  # of equal ones the first keys
                    order = np.argsort(d_keys, kind="stable")
                    at = order[np.argsort(np.where(fit, -shown, np.inf)[:, order], axis=1, kind="stable")[:, :k]]
                else:
                    at = np.argpartition(~fit, most - 1, axis=1)[:, :most]
                # a product's last bits depend on a row's place in its block: the found pairs are scored one by one
                score = np.empty(at.shape)
                for j in range(at.shape[1]):
                    x = b[at[:, j]]
                    score[:, j] = (a * x).sum(1) if metric == "dot" else -((a - x) ** 2).sum(1)
                new = np.take_along_axis(np.where(fit, shown, -np.inf), at, 1), d_keys[at], score
                shown, keys, score = (np.concatenate(x, axis=1) for x in zip(held, new, strict=True))
                by = np.argsort(keys, axis=1, kind="stable")
                by = np.take_along_axis(by, np.argsort(-np.take_along_axis(shown, by, 1), axis=1, kind="stable")[:, :k], 1)
                blocks[mine] = tuple(np.take_along_axis(x, by, 1) for x in (shown, keys, score))
        while blocks:
            yield out(next(iter(blocks)))

    found = q.join(d.hint("merge"), ["row", "col", "dim"]).mapInArrow(best, f"query_id {kinds[0]}, doc_key {kinds[1]}, score double")
    return top(found, k).select("query_id", "doc_key", "score", "rank")


def fuse(dense: DataFrame, sparse: DataFrame, k: int, method: str = "rrf", rrf_k: int = 60, w_dense: float = 0.5, w_sparse: float = 0.5) -> DataFrame:
    """Two rankings (query_id, doc_key, score, rank) as one: reciprocal ranks, or a weighted sum of scores.
    Ties go by dense rank, then sparse rank, then key; the channels' own ranks and scores stay, null where absent."""
    a = dense.select("query_id", "doc_key", F.col("rank").alias("dense_rank"), F.col("score").alias("dense_score"))
    b = sparse.select("query_id", "doc_key", F.col("rank").alias("bm25_rank"), F.col("score").alias("bm25_score"))
    both = a.join(b, ["query_id", "doc_key"], "full")
    if method == "rrf":
        one = lambda c: F.coalesce(F.lit(1.0) / (F.lit(rrf_k) + F.col(c)), F.lit(0.0))
        score = one("dense_rank") + one("bm25_rank")
    elif method == "linear":
        score = F.lit(float(w_dense)) * F.coalesce("dense_score", F.lit(0.0)) + F.lit(float(w_sparse)) * F.coalesce("bm25_score", F.lit(0.0))
    else:
        raise ValueError("method is rrf or linear")
    last = F.lit(2**31 - 1)
    w = Window.partitionBy("query_id").orderBy(F.round("fused", 12).desc(), F.coalesce("dense_rank", last), F.coalesce("bm25_rank", last), "doc_key")
    ranked = both.withColumn("fused", score).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "doc_key", "fused", "rank", "dense_rank", "dense_score", "bm25_rank", "bm25_score")


def retrieve(queries: DataFrame, index: Index | None, corpus: DataFrame | None, encode, mode: str = "hybrid", method: str = "rrf", dense_k: int = 30, sparse_k: int = 60, k: int = 30, **weights) -> DataFrame:
    """Hybrid retrieval of queries (query_id, text).  Only what the mode needs is planned; encode(Column) gives vectors."""
    if mode not in ("dense", "bm25", "hybrid"):
        raise ValueError("mode is dense, bm25 or hybrid")
    dense = nearest(queries.select("query_id", encode("text").alias("v")), corpus, dense_k) if mode != "bm25" else None
    sparse = bm25(index, queries, sparse_k) if mode != "dense" else None
    if mode == "hybrid":
        return fuse(dense, sparse, k, method, **weights)
    one = (dense if mode == "dense" else sparse).filter(F.col("rank") <= k)
    channel = lambda name, on: [F.when(F.lit(on), F.col("rank")).alias(f"{name}_rank"), F.when(F.lit(on), F.col("score")).alias(f"{name}_score")]
    return one.select("query_id", "doc_key", F.col("score").alias("fused"), "rank", *channel("dense", mode == "dense"), *channel("bm25", mode == "bm25"))


def hits(found: DataFrame, chunks: DataFrame, key: str = "chunk_id", text: str = "chunk_text") -> DataFrame:
    """Fused rows with their texts; keys that are not in chunks go."""
    return found.join(chunks.select(F.col(key).alias("doc_key"), F.col(text).alias("chunk_text")), "doc_key")


def only(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in keys (key), a stored table: few are sent to the rows, so that no other row's text is shuffled."""
    one = keys.select(key).distinct()
    return rows.join(F.broadcast(one) if keys.count() <= FEW else one, key, "left_semi")


def orphans(keys: DataFrame, universe: DataFrame, key: str) -> DataFrame:
    """Keys of an index that no chunk has."""
    return keys.select(key).distinct().join(universe.select(key), key, "left_anti")


def alignment(chunks: DataFrame, vectors: DataFrame, chunk_key: str, vector_key: str) -> DataFrame:
    """One row: chunks, vectors, and how many of each lack the other."""
    a, b = chunks.select(F.col(chunk_key).alias("k"), F.lit(1).alias("a")), vectors.select(F.col(vector_key).alias("k"), F.lit(1).alias("b"))
    both = a.join(b, "k", "full")
    return both.agg(*(F.coalesce(F.sum(x), F.lit(0)).cast("long").alias(n) for x, n in ((F.col("a"), "n_chunks"), (F.col("b"), "n_vectors"), (F.expr("int(b is null)"), "chunks_without"), (F.expr("int(a is null)"), "vectors_without"))))


def overlap_score(query: Column, text: Column) -> Column:
    """The default reranker: the part of the query's distinct tokens that the text holds."""
    q, d = F.array_distinct(T.tokenize(query)), T.tokenize(text)
    return F.coalesce(F.try_divide(F.size(F.array_intersect(q, d)).cast("double"), F.size(q).cast("double")), F.lit(0.0))


def rerank(rows: DataFrame, query: str = "query_text", text: str = "chunk_text", k: int | None = None) -> DataFrame:
    """rows (query_id, rank, ..) with rerank_score and rerank_rank, best first; ties keep the old order."""
    scored = rows.withColumn("rerank_score", overlap_score(F.col(query), F.col(text)))
    w = Window.partitionBy("query_id").orderBy(F.round("rerank_score", 6).desc(), "rank")
    scored = scored.withColumn("rerank_rank", F.row_number().over(w))
    return scored if k is None else scored.filter(F.col("rerank_rank") <= k)
