"""JSONL files as rows with an explicit order, one row a line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import json as J
from ..operators import scan


def file_path() -> Column:
    """A row's file as listings spell it; the reader's own column has spaces and other characters escaped."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def listing(spark: SparkSession, root: str, glob: str, recursive: bool = False) -> DataFrame:
    """(path, modified, bytes) of files, latest first; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(root)
    return files.select("path", F.unix_millis("modificationTime").alias("modified"), F.col("length").alias("bytes")).orderBy(F.desc("modified"), "path")


def records(spark: SparkSession, root: str, glob: str, recursive: bool = False, paths: list[str] | None = None) -> DataFrame:
    """(path, line, filled, record, data, json_ok) for each line that isn't blank, of the files at paths if given; others aren't opened.

    line counts all lines of the file before this one, filled those that aren't blank, record those that
    are JSON; lines that aren't have json_ok false, a torn last one among them. A large file is read by several tasks: lines are
    ordered by the file block they begin in and their place in it, and counted block by block. Lines end with \\n alone. A
    compressed file is one block, read line by line.
    """
    text = spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).text(root)
    if paths is not None:
        # a file's path is known from the listing, so this leaves files out before any is read
        text = text.where(file_path().isin(paths))
    rows = text.select(file_path().alias("path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"), F.col("value").alias("data"))
    filled = F.trim(F.regexp_replace("data", "[\r\t]", " ")) != ""
    rows = rows.withColumns({"_filled": filled, "json_ok": filled & J.parsed(F.col("data")).isNotNull()})
    count = lambda c: c.cast("long")
    placed = scan.running(rows, ["path"], F.col("_block"), "_row", sums={"line": F.lit(1).cast("long"), "filled": count(F.col("_filled")), "record": count(F.col("json_ok"))})
    return placed.where("_filled").select("path", "line", "filled", "record", "data", "json_ok")


def numbered(rows: DataFrame) -> DataFrame:
    """Readable records only; record numbers them from 0 within their file."""
    return rows.where("json_ok")


def malformed(rows: DataFrame) -> DataFrame:
    """(path, malformed): how many lines of a file couldn't be read, where any."""
    return rows.groupBy("path").agg(F.count_if(~F.col("json_ok")).alias("malformed")).where("malformed > 0")


def late_results(calls: DataFrame, results: DataFrame, session: str = "session_id") -> DataFrame:
    """calls plus the result that answers each: result_text, result_error, result_time (all NULL if none).

    A result binds to the latest call of its id that stands before it; of several
    results of a call the last counts; a result without an earlier call is
    ignored. calls(session, pos, call_id, ...), results(session, pos, call_id,
    text, is_error, time). Both sides run through one window, so repeated ids make no pairs.
    """
    fields = ("pos", "call_id")
    result = results.select(session, *fields, F.lit(1).alias("_side"), F.struct("text", "is_error", "time").alias("_result"))
    both = calls.select(session, *fields, F.lit(0).alias("_side"), F.lit(None).cast(result.schema["_result"].dataType).alias("_result")).unionByName(result)
    before = Window.partitionBy(session, "call_id").orderBy("pos", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bound = both.withColumn("_call", F.last(F.when(F.col("_side") == 0, F.col("pos")), ignorenulls=True).over(before)).where("_side = 1 and _call is not null")
    last = bound.groupBy(session, F.col("_call").alias("pos"), "call_id").agg(F.max_by("_result", "pos").alias("_result"))
    joined = calls.join(last, [session, *fields], "left")
    return joined.select(*calls.columns, F.col("_result.text").alias("result_text"), F.col("_result.is_error").alias("result_error"), F.col("_result.time").alias("result_time"))
