"""Stored log files: <root>/<project>/<session>/session[.vN].jsonl[.zstd], one header line, then events.

Spark's text reader decodes zstd files of any number of frames by their ending.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..checkpoint import cut
from ..functions import json as J
from ..functions.ids import by_locale
from . import lines

# The names of stored logs, and the escape of their folders.
GLOB = "session*.jsonl*"
#: Files of which an index is made; and files that are named to the reader one by one, beyond which all are read and joined.
INDEX = "path string, project string, stored_id string, version int, bytes bigint, modified bigint, target_id string, created_at bigint, cwd string"
NAMED = 1000
_FILE = ["path", "bytes", "modified"]


def segment(name):
    """A path segment with ~XXXX escapes decoded to the characters of those code points."""
    parts = F.split(name, "~(?=[0-9A-Fa-f]{4})", -1)
    head = F.get(parts, F.lit(0))
    rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.concat(F.decode(F.unhex(F.substring(p, 1, 4)), "UTF-16BE"), F.substring(p, F.lit(5), F.length(p))))
    return F.concat(head, F.array_join(rest, ""))


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, bytes, modified, project, stored_id, version, nth): nth 1 is a session's newest generation."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", GLOB).load(root).select("path", F.col("length").alias("bytes"), F.unix_millis("modificationTime").alias("modified"))
    pattern = r"([^/]+)/([^/]+)/session(?:\.v(\d+))?\.jsonl(?:\.zstd|\.zst)?$"
    named = files.where(F.col("path").rlike(pattern)).select(
        *_FILE, segment(F.regexp_extract("path", pattern, 1)).alias("project"), segment(F.regexp_extract("path", pattern, 2)).alias("stored_id"),
        F.coalesce(F.nullif(F.regexp_extract("path", pattern, 3), F.lit("")).cast("int"), F.lit(0)).alias("version"),
    )
    return _ranked(named)


def _ranked(files: DataFrame) -> DataFrame:
    return files.withColumn("nth", F.row_number().over(Window.partitionBy("project", "stored_id").orderBy(F.desc("version"), by_locale("path"), "path")))


def index(spark: SparkSession, root: str, known: DataFrame | None = None) -> DataFrame:
    """INDEX of all stored logs, every generation: each file's place and size, and what its header tells (null if it has none).

    known is an earlier index: files whose path, size and time of change are as they were aren't opened again, and
    files that are gone leave. An index is for the caller to keep, as a table; the one returned doesn't read known again.
    """
    there = cut(listing(spark, root).drop("nth"))
    known = spark.createDataFrame([], INDEX) if known is None else known
    fresh = cut(there.join(known, _FILE, "left_anti"))
    some = [r.path for r in fresh.select("path").limit(NAMED + 1).collect()]
    rows = lines.records(spark, root, GLOB, recursive=True, paths=some if len(some) <= NAMED else None).where("filled = 0").join(fresh.select("path"), "path", "left_semi")
    told = fresh.join(_headers(rows.withColumn("v", J.parsed(F.col("data")))).drop("version"), "path", "left")
    columns = [c.split()[0] for c in INDEX.split(", ")]
    return cut(known.join(there.select(_FILE), _FILE, "left_semi").select(columns).unionByName(told.select(columns)))


def _headers(rows: DataFrame) -> DataFrame:
    """(path, target_id, version, created_at, cwd) of files' first rows with their value as v, where they are headers."""
    v = F.col("v")
    return rows.where((F.col("filled") == 0) & (J.string(J.at(v, "$.type")) == "session")).select(
        "path", J.pick_string(v, "$.id").alias("target_id"), J.whole(J.at(v, "$.version")).cast("int").alias("version"), J.whole(J.at(v, "$.createdAt")).alias("created_at"), J.pick_string(v, "$.cwd").alias("cwd")
    )


def read(spark: SparkSession, root: str, newest: bool = True, paths: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(headers, events, summary) of stored logs.

    headers(path, target_id, version, created_at, cwd); events(path, line, type,
    seq, time, data) with the rest of an event as JSON; summary(path, events,
    chunk_rows, malformed). Arrays and rows of packed chunks count by what they hold.
    With paths, only these files are opened, whatever their generation.
    """
    rows = lines.records(spark, root, GLOB, recursive=True, paths=paths)
    if paths is None:
        wanted = listing(spark, root)
        rows = rows.join((wanted.where("nth = 1") if newest else wanted).select("path"), "path", "left_semi")
    rows = rows.withColumn("v", J.parsed(F.col("data")))
    v = F.col("v")
    type_ = J.string(J.at(v, "$.type"))
    what = F.when(v.isNull(), "malformed").when((F.col("filled") == 0) & (type_ == "session"), "header").when((J.kind(v) == "ARRAY") | type_.endswith("-chunks"), "chunks").otherwise("event")
    rows = rows.withColumn("what", what).withColumn("type", type_)
    length = lambda p: F.size(F.try_variant_get(v, p, "array<variant>"))
    held = F.when(F.col("what") == "chunks", F.greatest(F.lit(1), F.coalesce(F.nullif(F.greatest(length("$.texts"), length("$.args"), length("$")), F.lit(-1)), F.lit(1))))
    headers = _headers(rows)
    events = rows.where("what = 'event'").select("path", "line", "type", J.whole(J.at(v, "$.seq")).alias("seq"), J.whole(J.at(v, "$.time")).alias("time"), "data")
    summary = rows.groupBy("path").agg(F.count_if(F.col("what") == "event").alias("events"), F.coalesce(F.sum(held), F.lit(0)).alias("chunk_rows"), F.count_if(F.col("what") == "malformed").alias("malformed"))
    return headers, events, summary


def point_read(spark: SparkSession, root: str, target_id: str, known: DataFrame | None = None) -> DataFrame:
    """The events of the newest stored log with this id, of whose files one is opened; known is an up-to-date index, else one is made."""
    files = _ranked(index(spark, root) if known is None else known)
    # one path at most comes to the driver
    first = files.where((F.col("nth") == 1) & (F.col("target_id") == target_id)).orderBy(by_locale("path"), "path").select("path").head(1)
    return read(spark, root, paths=[r.path for r in first])[1].orderBy("line")


def stored_reasoning(events: DataFrame) -> DataFrame:
    """(path, position, text): the reasoning blocks of stored events, in order."""
    blocks = F.coalesce(F.try_variant_get(J.parsed(F.col("data")), "$.data.message.content", "array<variant>"), F.array().cast("array<variant>"))
    rows = events.where("type = 'assistant/message'").select("path", "line", F.posexplode(blocks).alias("i", "b")).where(J.string(J.at(F.col("b"), "$.type")) == "reasoning")
    order = Window.partitionBy("path").orderBy("line", "i")
    return rows.select("path", (F.row_number().over(order) - 1).alias("position"), F.coalesce(J.string(J.at(F.col("b"), "$.text")), F.lit("")).alias("text"))
