"""What the operators of this subpackage share: folders, row keys and Python workers' imports."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package (on a cluster, ship it with --py-files), and keep Arrow batches of texts small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, env.get("PYTHONPATH", "")]))


def shared_base(spark: SparkSession) -> str:
    """The shared folder named by the session in spark.checkpoint.dir; one of our own only where it is unset, on one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "textloom-shared")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder's name below the application's own in the shared one, which goes when the application ends."""
    own = f"{shared_base(spark)}/textloom-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(path):
        store.mkdirs(path)
        store.deleteOnExit(path)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def cut(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a Parquet table in the shared folder: survives lost executors, ends the lineage."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete the table that cut() made for df, which nothing reads any more."""
    spark = df.sparkSession
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if f"/textloom-{spark.sparkContext.applicationId}/" in path:
            path = spark._jvm.org.apache.hadoop.fs.Path(path)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text (null: empty), as two long columns k1 and k2."""
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("k1"), F.xxhash64(F.lit("#"), t).alias("k2")]


def unfit(docs: DataFrame, made: list[str]) -> None:
    """Refuse rows that already have a column of a name that an operator makes."""
    clash = sorted({c.lower() for c in docs.columns} & set(made))
    if clash:
        raise ValueError(f"rename these columns first, the operator makes them: {', '.join(clash)}")


#: Components of integer vectors are smaller than this, so that sums of squares and products of 4,096 of them fit a long with room for a factor of 2.
LARGEST = 2**24


def whole_vector(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as array<long>; null for a vector that is null, empty or holds null or
    non-finite components.  Components from LARGEST / scale on raise an error."""
    e = embedding.cast("array<double>")
    fine = (F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    far = F.exists(e, lambda x: F.abs(x) * scale >= LARGEST)
    v = F.transform(e, lambda x: F.floor(x * F.lit(float(scale))))
    return F.when(F.coalesce(fine, F.lit(False)), F.when(far, F.raise_error(F.lit(f"a vector's component is {LARGEST // scale} or more"))).otherwise(v))


def whole_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as the rows of an int64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_arrays(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """One file for each array; a rename makes each appear whole, so a repeated task does no harm."""
    store, base = _fs(uri)
    store.create_dir(base, recursive=True)
    for name, a in arrays.items():
        tmp = f"{base}/.{name}.{uuid.uuid4().hex}"
        with store.open_output_stream(tmp) as out:
            out.write(memoryview(np.ascontiguousarray(a)).cast("B") if a.size else b"")
        store.move(tmp, f"{base}/{name}")


def map_array(uri: str, dtype) -> np.ndarray:
    """A file of write_arrays, memory-mapped; one that isn't on a mounted store is first copied to a temporary folder that goes with the worker."""
    if uri.startswith("file:"):
        path = "/" + uri[5:].lstrip("/")
    elif uri.startswith("/"):
        path = uri
    else:
        store, base = _fs(uri)
        tmp = tempfile.mkdtemp(prefix="textloom-")
        atexit.register(shutil.rmtree, tmp, True)
        path = os.path.join(tmp, "a")
        with store.open_input_stream(base) as src, open(path, "wb") as out:
            shutil.copyfileobj(src, out)
    if not os.path.getsize(path):
        return np.empty(0, dtype)
    return np.memmap(path, dtype=dtype, mode="r")
