"""Cutting lineage in the shared folder: for loops over DataFrames, and for tables that a query reads several times."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def base(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; one of our own only where that is unset, on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + os.path.join(tempfile.gettempdir(), "textloom-checkpoints")
    return folder.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of blocks (rows of half a megabyte) stay small: 8 MB in this session, or less if it says so."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name, None)
    if now is None or not now.endswith(("k", "m")) or (now.endswith("m") and int(now[:-1]) > 8):
        spark.conf.set(name, "8m")


def cut(df: DataFrame) -> DataFrame:
    """df.checkpoint() in the shared folder."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(base(df.sparkSession))
    return df.checkpoint()


def place(spark: SparkSession, name: str) -> str:
    """A new folder's name in the application's own part of the shared folder, which goes when the application ends."""
    own = f"{base(spark)}/textloom-tables-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(path):
        store.mkdirs(path)
        store.deleteOnExit(path)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a Parquet table in the shared folder, so that later scans still prune columns; it goes when the application ends."""
    path = place(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def version(spark: SparkSession, path: str) -> str:
    """What tells a table's files from later ones: their names, sizes and times."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files, out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(at, True), []
    while files.hasNext():
        f = files.next()
        out.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return "\n".join(sorted(out))
