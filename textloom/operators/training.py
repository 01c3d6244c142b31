"""Training rows for a reranker, splits without leaks, losses and ranking metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.functions import text as T
from textloom.operators.lineage import stored
from textloom.operators.mining import by_hash


def valid_count(n: Column, ratio: float) -> Column:
    """Rows of the validation part: n (1 - ratio), halves to even, at least one."""
    return F.greatest(F.bround(n * F.lit(1.0 - ratio)).cast("long"), F.lit(1))


def split(rows: DataFrame, ratio: float = 0.85, seed: int = 42, key: str = "query_id") -> DataFrame:
    """rows with split (train or valid): ids are dealt whole, by a hash order."""
    ids = rows.select(key).distinct()
    total = ids.agg(F.count("*").alias("n")).select(valid_count(F.col("n"), ratio).alias("n_valid"))
    picked = smallest(ids.withColumn("h", by_hash(key, seed)), total)
    return rows.join(picked.select(key, F.lit("valid").alias("split")), key, "left").withColumn("split", F.coalesce("split", F.lit("train")))


def smallest(rows: DataFrame, count: DataFrame) -> DataFrame:
    """The n_valid rows of least h (hex).  Rows are counted by the first four digits of h, so only one such range is ranked."""
    marked = rows.withColumn("b", F.left("h", F.lit(4)))
    sizes = marked.groupBy("b").agg(F.count("*").alias("size"))
    before = sizes.withColumn("before", F.coalesce(F.sum("size").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # 65,536 rows at most
    limits = before.join(F.broadcast(count)).filter("before < n_valid").select("b", "before", "n_valid")
    w = Window.partitionBy("b").orderBy("h")
    return marked.join(limits, "b").withColumn("place", F.row_number().over(w) + F.col("before")).filter("place <= n_valid").drop("b", "before", "n_valid", "place")


def split_counts(rows: DataFrame, key: str = "query_id") -> DataFrame:
    one = lambda s: F.count_distinct(F.when(F.col("split") == s, F.col(key)))
    return rows.agg(F.count_distinct(key).alias("total_ids"), one("train").alias("train_ids"), one("valid").alias("valid_ids"))


def random_chunks(needs: DataFrame, pool: DataFrame, excluded: DataFrame, seed: int) -> DataFrame:
    """needs (draw, query_id) with a chunk_id of pool (n from 0, chunk_id) not excluded (query_id, chunk_id) for it.

    A draw is the hash(seed:draw)-th of the chunks allowed for its query, counted past the excluded places in
    order, so every draw finds one.  A query for which the whole pool is excluded has none and no row."""
    size = pool.agg(F.count("*").alias("size"))
    places = excluded.select("query_id", "chunk_id").distinct().join(pool, "chunk_id").groupBy("query_id").agg(F.array_sort(F.collect_list(F.col("n").cast("long"))).alias("banned"))  # a pack's chunks
    asked = needs.select("draw", "query_id").join(places, "query_id", "left").join(F.broadcast(size))  # one row
    asked = asked.withColumn("banned", F.coalesce("banned", F.array().cast("array<bigint>"))).filter(F.col("size") > F.size("banned"))
    free = F.col("size") - F.size("banned")
    start = F.conv(F.left(T.sha256(F.concat(F.lit(f"{seed}:"), "draw")), F.lit(15)), 16, 10).cast("long") % F.when(free > 0, free)
    place = F.aggregate("banned", start, lambda n, x: n + (x <= n).cast("long"))
    return asked.withColumn("n", place).join(pool.select(F.col("n").cast("long").alias("n"), "chunk_id"), "n").select("draw", "query_id", "chunk_id")


def epoch_pairs(packs: DataFrame, pool: DataFrame, epoch: int, seed: int = 42, random_per_positive: int = 1) -> DataFrame:
    """(query_id, positive, negative, type, epoch) of packs (query_id, source_id, positives, negatives).

    Hard negatives per positive: none if a pack has none (one random chunk that is no positive instead),
    one, drawn with repeats, if it has fewer than positives, else floor(negatives / positives) without
    repeats.  With hard ones come random_per_positive random chunks that are neither source, positive nor
    negative.  A pack without positives fails the query.
    """
    packs = stored(packs, "packs")  # read by every kind of negative
    checked = packs.filter(F.assert_true(F.size("positives") > 0, F.lit("a pack has no positives")).isNull())
    rows = checked.select("query_id", "source_id", "positives", "negatives", F.posexplode("positives").alias("i", "positive"))
    p, h, s = F.size("positives"), F.size("negatives"), f"{seed + epoch}:"
    draw = F.concat("query_id", F.lit(":"), F.col("i").cast("string"))
    rank = lambda x: T.sha256(F.concat(F.lit(s), draw, F.lit(":"), x))
    shuffled = F.transform(F.array_sort(F.transform("negatives", lambda n: F.struct(rank(n).alias("r"), n.alias("n")))), lambda x: x["n"])
    one = F.slice(shuffled, 1, 1)
    hard = rows.select("query_id", "positive", F.explode(F.when(h == 0, F.array().cast("array<string>")).when(h < p, one).otherwise(F.slice(shuffled, F.lit(1), F.floor(h / p).cast("int")))).alias("negative"), F.lit("hard_negative").alias("type"))
    strict = packs.select("query_id", F.explode(F.concat(F.array("source_id"), "positives", "negatives")).alias("chunk_id"))
    some = rows.filter(h > 0).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(random_per_positive - 1)))) if random_per_positive > 0 else None
    parts = [hard]
    if some is not None:
        needs = some.select("query_id", "positive", F.concat(draw, F.lit(":"), F.col("k").cast("string")).alias("draw"))
        parts.append(needs.join(random_chunks(needs.select("draw", "query_id"), pool, strict, seed + epoch), ["draw", "query_id"]).select("query_id", "positive", F.col("chunk_id").alias("negative"), F.lit("random_negative").alias("type")))
    needs = rows.filter(h == 0).select("query_id", "positive", F.concat(draw, F.lit(":f")).alias("draw"))
    positives = packs.select("query_id", F.explode("positives").alias("chunk_id"))
    parts.append(needs.join(random_chunks(needs.select("draw", "query_id"), pool, positives, seed + epoch), ["draw", "query_id"]).select("query_id", "positive", F.col("chunk_id").alias("negative"), F.lit("random_negative_fallback").alias("type")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out.withColumn("epoch", F.lit(epoch))


def eval_packs(packs: DataFrame, cap: int, seed: int = 42) -> DataFrame:
    """(query_id, doc_ids, labels): positives, then at most cap negatives by a hash order; packs without positives go."""
    ordered = F.transform(F.array_sort(F.transform("negatives", lambda n: F.struct(T.sha256(F.concat(F.lit(f"{seed}:"), F.col("query_id"), F.lit(":"), n)).alias("r"), n.alias("n")))), lambda x: x["n"])
    few = F.slice(ordered, 1, cap) if cap > 0 else F.array().cast("array<string>")
    labels = F.concat(F.transform("positives", lambda _: F.lit(1)), F.transform(few, lambda _: F.lit(0)))
    return packs.filter(F.size("positives") > 0).select("query_id", F.concat("positives", few).alias("doc_ids"), labels.alias("labels"))


def pairwise_loss(positive: Column, negative: Column) -> Column:
    """softplus(-(s+ - s-)), stable for large differences."""
    d = positive - negative
    return F.greatest(-d, F.lit(0.0)) + F.log1p(F.exp(-F.abs(d)))


def margin_loss(positive: Column, negative: Column, margin: float = 1.0) -> Column:
    return F.greatest(F.lit(0.0), F.lit(margin) - (positive - negative))


def ranking_metrics(rows: DataFrame, k: int = 10) -> DataFrame:
    """One row: num_queries, ndcg, mrr of rows (query_id, pos, score, rel), macro means; no relevant row counts 0."""
    w = Window.partitionBy("query_id")
    ranked = rows.withColumn("r", F.row_number().over(w.orderBy(F.round("score", 6).desc(), "pos"))).withColumn("ideal", F.row_number().over(w.orderBy(F.desc("rel"), "pos")))
    gain = lambda place: F.sum(F.when(F.col(place) <= k, F.col("rel") / F.log2(F.col(place) + F.lit(1.0))).otherwise(0.0))
    per = ranked.groupBy("query_id").agg(gain("r").alias("dcg"), gain("ideal").alias("best"), F.min(F.when((F.col("rel") > 0) & (F.col("r") <= k), F.col("r"))).alias("first"))
    return per.agg(F.count("*").alias("num_queries"), F.coalesce(F.avg(F.when(F.col("best") > 0, F.col("dcg") / F.col("best")).otherwise(0.0)), F.lit(0.0)).alias("ndcg"), F.coalesce(F.avg(F.coalesce(F.lit(1.0) / F.col("first"), F.lit(0.0))), F.lit(0.0)).alias("mrr"))


def train_reranker(pairs: DataFrame, epochs: int = 20):
    """A linear reranker on differences of features: pairs (pos_features, neg_features: arrays), each seen from both sides; a pyspark.ml model."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    difference = F.zip_with("pos_features", "neg_features", lambda a, b: a - b)
    rows = pairs.select(difference.alias("d"), F.lit(1.0).alias("label")).unionByName(pairs.select(F.transform(difference, lambda x: -x).alias("d"), F.lit(0.0).alias("label")))
    return LogisticRegression(maxIter=epochs, fitIntercept=False, regParam=0.01).fit(rows.select(array_to_vector("d").alias("features"), "label"))


def rerank_score(model, features: Column) -> Column:
    """The model's score of an array of features."""
    out = F.lit(0.0)
    for i, w in enumerate(model.coefficients):
        out = out + F.get(features, F.lit(i)) * F.lit(float(w))
    return out
