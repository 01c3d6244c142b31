"""Query generation as a stream that stops at a target and goes on where it stopped.

Sampled chunks lie in files as numbered parts.  The stream generates and classifies queries part by part, in
parallel; one keyed state takes them in order: ids seen, queries waiting for a whole micro-batch, and how many
in-domain queries the batches so far have given.  A batch runs only while the target isn't reached, and whole;
later parts then pass without output.  The state lives in the checkpoint, so a run that was stopped or failed
goes on with the next part, and all runs together give the rows of mining.query_run over the same chunks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType

from textloom.functions import text as T
from textloom.operators import mining
from textloom.operators.lineage import stored
from textloom.streaming.incremental import run_to_end, table_stream

PART = "chunk_id string, chunk_text string, ord long, part int, last boolean"
WAITING = "query_id string, query_text_norm string, chunk_id string, chunk_ord long, place int, in_domain boolean, part int, last boolean"
HELD = "query_id string, query_text_norm string, chunk_id string, in_domain boolean"
OUT = "query_id string, query_text_norm string, source_chunk_ids array<string>, domain string, batch long"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def write_parts(chunks: DataFrame, path: str, cap: int = 6500, seed: int = 42, size: int = 500) -> int:
    """A sample of chunks (chunk_id, chunk_text, ord) as parts of about `size` chunks in order of ord, each in one
    file; how many parts.  The last one is marked."""
    picked = stored(mining.numbered(mining.sample(chunks.select("chunk_id", "chunk_text", "ord"), cap, seed), ["ord", "chunk_id"]), "sampled")
    n = picked.count()
    parts = -(-n // size)
    rows = picked.withColumn("part", F.floor(F.col("n") / size).cast("int")).withColumn("last", F.col("part") == parts - 1).drop("n")
    rows.repartition(max(1, parts), "part").sortWithinPartitions("part", "ord").write.mode("overwrite").parquet(path)
    return parts


class TargetState(StatefulProcessor):
    """Whole batches of `size` queries in order until `target` in-domain ones are there."""

    def __init__(self, target: int, size: int):
        self.target, self.size = target, size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.progress = handle.getValueState("progress", "part int, batch long, hits long")
        self.waiting = handle.getListState("waiting", WAITING)
        self.held = handle.getListState("held", HELD)
        self.seen = handle.getMapState("seen", StructType([StructField("query_id", StringType())]), "part int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        part, batch, hits = self.progress.get() if self.progress.exists() else (0, 0, 0)
        names = [f.split()[0] for f in WAITING.split(", ")]
        items = [tuple(r) for frame in rows for r in frame[names].itertuples(index=False, name=None)]
        if self.waiting.exists():  # parts that came before their turn
            items += [tuple(r) for r in self.waiting.get()]
        by_part: dict[int, list[tuple]] = {}
        for r in items:
            by_part.setdefault(int(r[6]), []).append(r)
        held = [tuple(r) for r in self.held.get()] if self.held.exists() else []
        out = []

        def flush(n: int) -> None:
            nonlocal held, batch, hits
            out.extend((i, t, [c], "in" if ok else "out", batch) for i, t, c, ok in held[:n])
            hits += sum(bool(ok) for _, _, _, ok in held[:n])
            batch += 1
            held = held[n:]

        while part in by_part:
            now = sorted((r for r in by_part.pop(part) if r[0] is not None and hits < self.target), key=lambda r: (r[3], r[4], r[0]))
            for query_id, text, chunk_id, *_, ok, _, _ in now:
                if hits < self.target and not self.seen.containsKey((query_id,)):
                    self.seen.updateValue((query_id,), (part,))
                    held.append((query_id, text, chunk_id, bool(ok)))
                    if len(held) == self.size:
                        flush(self.size)
            part += 1
            if part - 1 in self.ends(items) and held and hits < self.target:
                flush(len(held))
        if hits >= self.target:
            held = []
        self.progress.update((part, batch, hits))
        for state, left in ((self.held, held), (self.waiting, [r for p in sorted(by_part) for r in by_part[p]])):
            if left:
                state.put(left)
            else:
                state.clear()
        yield pd.DataFrame(out, columns=[f.split()[0] for f in OUT.split(", ")])

    @staticmethod
    def ends(items: list[tuple]) -> set[int]:
        return {int(r[6]) for r in items if r[7]}

    def close(self) -> None:
        pass


def query_stream(spark: SparkSession, parts: str, target: int, previous: DataFrame | None = None, size: int = 15, classify: Callable[[Column], Column] = mining.keyword_domain, files: int = 4, **options) -> DataFrame:
    """The stream of OUT's rows from the parts below a path.  previous (query_id, domain): queries that are there
    already; they aren't made again and count for the target, as they were when the stream was first started."""
    done = 0
    if previous is not None:
        known = stored(previous.select("query_id", "domain"), "previous-queries")
        done = known.filter("domain = 'in'").count()
    rows = mining.candidates(table_stream(spark, parts, PART, files), keep=("part", "last"), **options)
    rows = rows.withColumn("in_domain", F.when(F.col("query_id").isNotNull(), classify(T.col("query_text_norm"))))
    if previous is not None:  # those that are known stay as marks of their part
        known = known.select("query_id").distinct().withColumn("known", F.lit(True))
        rows = rows.join(known, "query_id", "left").withColumn("query_id", F.when(F.col("known").isNull(), F.col("query_id"))).drop("known")
    names = [f.split()[0] for f in WAITING.split(", ")]
    state = TargetState(max(0, target - done), size)
    return rows.select(F.lit("all").alias("run"), *names).groupBy("run").transformWithStateInPandas(statefulProcessor=state, outputStructType=OUT, outputMode="Append", timeMode="None")


def run(spark: SparkSession, parts: str, out: str, checkpoint: str, target: int, **options) -> DataFrame:
    """Processes the parts that are there and stops; called again, it goes on from the checkpoint.  Returns all rows so far."""
    was = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        run_to_end(query_stream(spark, parts, target, **options), out, checkpoint)
    finally:
        spark.conf.set(PROVIDER, was)
    return spark.read.schema(OUT).parquet(out)
