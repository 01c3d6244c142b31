"""Routing, contexts, answers and their evaluation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators.retrieve import overlap_score

HEADER = "Document:\n"


def route(query, keywords: list[str]) -> Column:
    """(use_rag, confidence, reason) by keywords; an empty query is never routed.  Without a model the rest isn't."""
    q = T.strip(T.safe(query))
    choose = lambda a, b, c: F.struct(F.lit(a).alias("use_rag"), F.lit(b).alias("confidence"), F.lit(c).alias("reason"))
    return F.when(q == "", choose(False, 0.0, "empty query")).when(T.contains_any(q, keywords), choose(True, 0.99, "keyword")).otherwise(choose(False, 0.5, "no keyword"))


def decision(use_rag: Column, confidence: Column, least: float = 0.5, force_out: bool = True) -> Column:
    """A model's routing with its confidence clamped; a low one goes out if forced."""
    c = T.clamp(confidence)
    return F.coalesce(use_rag, F.lit(False)) & (~F.lit(force_out) | (c >= F.lit(least)))


def context(docs: Column, max_docs: int, max_tokens: int) -> Column:
    """Texts joined under headers within a budget of 0.8 * 4 characters a token; the last may be cut."""
    budget = int(max_tokens * 4 * 0.8)
    start = F.struct(F.lit(0).alias("used"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, doc: Column) -> Column:
        remain = F.lit(budget) - acc["used"]
        t = T.strip(T.safe(doc))
        limit = F.greatest(F.lit(0), remain - F.lit(len(HEADER)))
        body = F.when(F.length(t) <= limit, t).otherwise(F.concat(T.rstrip(F.left(t, limit)), F.lit("…")))
        piece = F.concat(F.lit(HEADER), body, F.lit("\n"))
        return F.when(remain <= 0, acc).otherwise(F.struct((acc["used"] + F.length(piece)).alias("used"), F.concat(acc["parts"], F.array(piece)).alias("parts")))

    done = F.aggregate(F.slice(docs, 1, max_docs), start, step)
    return T.strip(F.array_join(done["parts"], "\n"))


def classify_prompt(query, docs: Column, max_chars: int = 2000) -> Column:
    """The variable end of an answerability prompt: the query, then numbered documents, each cut to max_chars."""
    flat = lambda c: F.replace(T.strip(T.safe(c)), F.lit("\n"), F.lit(" "))
    cut = lambda d: F.when(F.length(d) > max_chars, F.concat(F.left(d, F.lit(max_chars)), F.lit("..."))).otherwise(d)
    lines = F.transform(docs, lambda d, i: F.concat(i.cast("string"), F.lit(": "), cut(flat(d))))
    return F.concat(F.lit("Query:\n"), flat(query), F.lit("\n\nDocuments:\n"), F.array_join(lines, "\n"))


def first_sentence(query: Column, text: Column) -> Column:
    """The default answerer: the first sentence of the context's first text."""
    return T.strip(F.element_at(F.split(T.strip(T.safe(text)), r"[.!?\n]", 2), 1))


def valid_answer(answer, phrases: list[str], limit: int = 900) -> Column:
    """An answer cut to limit; empty where it says that there is none."""
    a = T.strip(T.safe(answer))
    return F.when(T.contains_any(a, phrases), "").otherwise(F.when(F.length(a) > limit, T.rstrip(F.left(a, F.lit(limit)))).otherwise(a))


def judge(answer: Column, gold: Column) -> Column:
    """The default judge: token F1 of distinct tokens."""
    a, g = F.array_distinct(T.tokenize(answer)), F.array_distinct(T.tokenize(gold))
    same = F.size(F.array_intersect(a, g)).cast("double")
    return F.coalesce(F.try_divide(F.lit(2.0) * same, (F.size(a) + F.size(g)).cast("double")), F.lit(0.0))


def judge_summary(rows: DataFrame) -> DataFrame:
    """(system, n, accuracy, mean_score) of rows (system, is_correct, score); empty input gives no rows."""
    return rows.groupBy("system").agg(F.count("*").alias("n"), F.avg(F.col("is_correct").cast("double")).alias("accuracy"), F.avg(T.clamp("score")).alias("mean_score"))


def echo(query: Column) -> Column:
    """The default answerer without documents: the question itself."""
    return T.strip(T.safe(query))


def grounded(queries: DataFrame, found: DataFrame, max_docs: int = 2, max_tokens: int = 20000, answer: Callable[[Column, Column], Column] = first_sentence) -> DataFrame:
    """(query_id, answer, context) of queries (query_id, text) from what was found (query_id, chunk_text, rank), reranked by overlap."""
    rag = queries.select("query_id", "text").join(found.select("query_id", "chunk_text", "rank"), "query_id", "left")
    scored = rag.withColumn("s", F.round(overlap_score(F.col("text"), F.col("chunk_text")), 6))
    docs = scored.groupBy("query_id", "text").agg(F.transform(F.array_sort(F.collect_list(F.when(F.col("chunk_text").isNotNull(), F.struct((-F.col("s")).alias("s"), "rank", "chunk_text")))), lambda x: x["chunk_text"]).alias("docs"))
    return docs.select("query_id", F.coalesce(answer(F.col("text"), F.get("docs", F.lit(0))), F.lit("")).alias("answer"), context(F.col("docs"), max_docs, max_tokens).alias("context"))


def answer_chain(queries: DataFrame, found: DataFrame, keywords: list[str], max_docs: int = 2, max_tokens: int = 20000, answer: Callable[[Column, Column], Column] = first_sentence, direct: Callable[[Column], Column] = echo) -> DataFrame:
    """(query_id, mode, answer, context) of queries (query_id, text): routed ones get an answer from what was
    found (query_id, chunk_text, rank), reranked by overlap; others a direct one; blanks an empty one."""
    routed = queries.withColumn("router", route("text", keywords))
    rag = grounded(routed.filter("router.use_rag"), found, max_docs, max_tokens, answer)
    alone = routed.filter("not router.use_rag")
    plain = F.when(T.strip(T.safe("text")) == "", "").otherwise(direct(F.col("text")))
    return rag.select("query_id", F.lit("rag").alias("mode"), "answer", "context").unionByName(alone.select("query_id", F.lit("direct").alias("mode"), plain.alias("answer"), F.lit("").alias("context")))


def direct_versus_rag(queries: DataFrame, found: DataFrame, max_docs: int = 2, max_tokens: int = 20000, answer: Callable[[Column, Column], Column] = first_sentence, direct: Callable[[Column], Column] = echo, score: Callable[[Column, Column], Column] = judge, least: float = 0.5) -> DataFrame:
    """(query_id, system, answer, score, is_correct): every question of queries (query_id, text, gold) answered both
    ways, direct and from what was found, and judged against gold; right from a score of `least` on.  For judge_summary()."""
    rag = grounded(queries, found, max_docs, max_tokens, answer).select("query_id", F.lit("rag").alias("system"), "answer")
    alone = queries.select("query_id", F.lit("direct").alias("system"), direct(F.col("text")).alias("answer"))
    judged = rag.unionByName(alone).join(queries.select("query_id", "gold"), "query_id").withColumn("score", T.clamp(score(F.col("answer"), F.col("gold"))))
    return judged.select("query_id", "system", "answer", "score", (F.col("score") >= least).alias("is_correct"))


def qa_rows(queries: DataFrame, grounded: DataFrame, phrases: list[str], answer: Callable[[Column, Column], Column] = first_sentence) -> DataFrame:
    """(query_id, question, answer, used_ids) of queries (query_id, query_text) and their grounded sources; empty answers go."""
    rows = queries.join(grounded, "query_id")
    made = rows.select("query_id", T.strip("query_text").alias("question"), valid_answer(answer(F.col("query_text"), F.col("chunk_text")), phrases).alias("answer"), "used_ids")
    return made.filter("answer <> ''")
