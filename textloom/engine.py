"""Questions in, answers with their sources out: retrieval, routing, context and answer as one object."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators import answer, retrieve


class Engine:
    """An index, its documents (key, text) and what answers; corpus (doc_key, v) and encode where the mode uses vectors.

    chain goes to answer_chain: max_docs, max_tokens, answer, direct."""

    def __init__(self, index: retrieve.Index | None, documents: DataFrame, keywords: list[str], key: str = "doc_id", text: str = "text", corpus: DataFrame | None = None, encode: Callable[[str], Column] | None = None, mode: str = "bm25", k: int = 5, **chain):
        self.index, self.documents, self.keywords = index, documents.select(F.col(key).alias("doc_key"), F.col(text).alias("chunk_text")), keywords
        self.corpus, self.encode, self.mode, self.k, self.chain = corpus, encode, mode, k, chain

    def answers(self, queries: DataFrame) -> DataFrame:
        """(query_id, mode, answer, context, sources) of queries (query_id, text); sources are the keys of what was
        found, in order of rank, empty where the question wasn't routed to the documents."""
        found = retrieve.retrieve(queries, self.index, self.corpus, self.encode, self.mode, dense_k=self.k, sparse_k=self.k, k=self.k)
        found = found.select("query_id", "doc_key", "rank").join(self.documents, "doc_key")
        keys = found.groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "doc_key"))), lambda x: x["doc_key"].cast("string")).alias("keys"))
        made = answer.answer_chain(queries, found, self.keywords, **self.chain).join(keys, "query_id", "left")
        return made.select("query_id", "mode", "answer", "context", F.when(F.col("mode") == "rag", F.coalesce("keys", F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>")).alias("sources"))

    def ask(self, question: str) -> dict:
        """One question's answer as a dict: mode, answer, context, sources."""
        spark = self.documents.sparkSession
        row = self.answers(spark.createDataFrame([(0, question)], "query_id long, text string")).first()
        return {name: row[name] for name in ("mode", "answer", "context", "sources")}
