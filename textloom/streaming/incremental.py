"""Incremental counterparts on Structured Streaming: new chunks once, manifests merged, event windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textloom.operators.crawl import latest


def table_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 64) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def new_once(stream: DataFrame, key: str, event_time: str | None = None, late: str = "7 days") -> DataFrame:
    """Rows whose key was not seen before; with an event time, state older than `late` is let go."""
    return stream.withWatermark(event_time, late).dropDuplicatesWithinWatermark([key]) if event_time else stream.dropDuplicates([key])


def windowed_counts(stream: DataFrame, time: str = "ts", window: str = "1 hour", late: str = "1 day", keys: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """Counts and sums of tumbling event-time windows; later rows than the watermark are dropped.  An addition of ours."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def merge_manifest(batch: DataFrame, previous: DataFrame) -> DataFrame:
    """Entries (url, ord, ..) of a batch over the ones before: the last of each url."""
    return latest(previous.unionByName(batch)).drop("first_ord")


def run_to_end(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process all there is, then stop; a rerun goes on from the checkpoint."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()


def append_new(rows: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Batch form: rows whose key is not in the table yet, once each (the first in order of ord)."""
    fresh = rows.join(existing.select(key).distinct(), key, "left_anti")
    named = [c for c in fresh.columns if c != key]
    first = fresh.groupBy(key).agg(F.min(F.struct("ord", *(c for c in named if c != "ord"))).alias("r"))
    return first.select(key, *(F.col(f"r.{c}").alias(c) for c in named))
