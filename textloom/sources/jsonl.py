"""JSON lines: strict or tolerant scans with a quarantine, overwrite and append sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from textloom.functions import text as T


def numbered_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(lines, splits): all lines of the files of a path (value, path, start: of the split, id: of the line in the scan),
    and of each split its first id, its number of lines and how many lines of its file stand before it.

    Files are read in splits, each in one task, so a line's place in its split is the distance of ids, and a sum over
    the splits before it, a row each, gives the place in the file.  Both tables scan the files alike; placed() fails
    where they don't."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"))
    sizes = lines.groupBy("path", "start").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    return lines, sizes.withColumn("before", F.coalesce(before, F.lit(0)))


def placed(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """Some of the lines with line_no, from 1, in place of start and id."""
    at = F.col("id") - F.col("first")
    no = F.when((at >= 0) & (at < F.col("n")), F.col("before") + at + 1).otherwise(F.raise_error(F.lit("the files were split in another way meanwhile")))
    return lines.join(splits, ["path", "start"], "left").withColumn("line_no", no).drop("start", "id", "first", "n", "before")


def is_object(c) -> Column:
    """Whether a string is one JSON object and nothing else (an object that repeats a key is none).  The parser passes
    over what follows a value, so the string is read as the only item of an array, and where it could end the array
    itself also as a member of an object."""
    text = T.col(c)
    items = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    one = F.startswith(F.schema_of_variant(F.try_variant_get(items, "$[0]", "variant")), F.lit("OBJECT")) & F.try_variant_get(items, "$[1]", "variant").isNull()
    member = ~F.contains(text, F.lit("]")) | F.try_parse_json(F.concat(F.lit('{"x":'), text, F.lit("}"))).isNotNull()
    return F.coalesce(one & member, F.lit(False))


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, errors).  Blank lines are skipped; a line that is no JSON object is an error: it fails a strict
    scan, and is quarantined otherwise: (path, line_no, error, line_preview), the preview of 200 bytes."""
    lines, splits = numbered_lines(spark, path)
    marked = lines.filter(T.strip("value") != "").withColumn("ok", is_object("value"))
    if strict:
        checked = marked.filter(F.assert_true("ok", F.concat(F.lit("not a JSON object: "), F.left("value", F.lit(200)))).isNull())
        bad = spark.createDataFrame([], "path string, line_no long, error string, line_preview string")
        return checked.select(F.from_json("value", schema).alias("r")).select("r.*"), bad
    good = marked.filter("ok").select(F.from_json("value", schema).alias("r")).select("r.*")
    preview = F.make_valid_utf8(F.substring(F.encode("value", "UTF-8"), 1, 200).cast("string"))
    bad = placed(marked.filter("not ok"), splits).select("path", "line_no", F.lit("not a JSON object").alias("error"), preview.alias("line_preview"))
    return good, bad


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def quarantine(rows: DataFrame, key: str, text: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with an error).  A good row has a key and a text that is not blank; strict: a bad one fails the query."""
    error = F.when(F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) == "", "missing key").when(F.coalesce(F.trim(text), F.lit("")) == "", "blank text")
    marked = rows.withColumn("error", error)
    if strict:
        return marked.filter(F.assert_true(F.col("error").isNull(), F.col("error")).isNull()).drop("error"), marked.limit(0)
    return marked.filter("error is null").drop("error"), marked.filter("error is not null")
