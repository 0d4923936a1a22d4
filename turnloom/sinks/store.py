"""The event store and the registry: Parquet tables dealt by a hash of the session."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Protocol

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..checkpoint import cut
from ..functions.ids import DIGEST_VERSION
from ..operators.chain import HEADS, heads_of
from ..operators.events import FIELDS

BUCKETS = 64
EVENTS = "session_id string, seq bigint, " + ", ".join(f"{n} {t}" for n, t in FIELDS.items()) + ", source_event_seqs array<bigint>"
EVENT_COLUMNS = ["session_id", "seq", *FIELDS, "source_event_seqs"]


def bucket_of(session: str = "session_id"):
    return F.pmod(F.xxhash64(session), F.lit(BUCKETS)).cast("int").alias("bucket")


class Sink(Protocol):
    """events and headers are those of the sessions ids(session_id), or all."""

    kind: str

    def events(self, ids: DataFrame | None = None) -> DataFrame: ...

    def headers(self, ids: DataFrame | None = None) -> DataFrame: ...

    def heads(self, ids: DataFrame | None = None) -> DataFrame: ...

    def readable(self, ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]: ...

    def append(self, events: DataFrame, headers: DataFrame, heads: DataFrame | None = None) -> None: ...


class ParquetSink:
    """Logs under a folder. An append adds files of a batch and then the batch's name, and only named batches are read."""

    kind = "parquet"

    def __init__(self, spark: SparkSession, root: str, format_version: int = 0, guard: Callable[[], None] | None = None):
        """guard is asked before an append is committed, and raises if another run has taken the store over."""
        self.spark, self.root, self.format_version, self.guard = spark, root.rstrip("/"), format_version, guard

    def _fs(self, path: str):
        made = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return made, made.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def batches(self) -> list[str]:
        """Names of the batches that were written to their end; one for each append."""
        path, fs = self._fs(f"{self.root}/batches")
        return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []

    def _read(self, name: str, layout: str, ids: DataFrame | None, damaged: bool = False) -> DataFrame:
        """damaged: files that can't be read are passed over."""
        path, fs = self._fs(f"{self.root}/{name}")
        if not fs.exists(path):
            return self.spark.createDataFrame([], layout)
        reader = self.spark.read.schema(f"{layout}, batch string, bucket int").option("ignoreCorruptFiles", str(damaged).lower()).option("ignoreMissingFiles", str(damaged).lower())
        rows = reader.parquet(f"{self.root}/{name}")
        rows = rows.where(F.col("batch").isin(self.batches()))
        if ids is not None:
            # at most BUCKETS numbers come to the driver; folders of other buckets aren't read
            buckets = [r.bucket for r in ids.select(bucket_of()).distinct().collect()]
            rows = rows.where(F.col("bucket").isin(buckets)).join(ids.select("session_id"), "session_id", "left_semi")
        return rows.select(*(c.name for c in rows.schema if c.name not in ("batch", "bucket")))

    def events(self, ids: DataFrame | None = None) -> DataFrame:
        return self._read("events", EVENTS, ids)

    def headers(self, ids: DataFrame | None = None) -> DataFrame:
        return self._read("headers", schema.HEADERS, ids)

    def heads(self, ids: DataFrame | None = None) -> DataFrame:
        """Each log's head after its last append. The logs of appends that gave none are read for theirs."""
        rows = self._read("heads", HEADS, ids)
        fields = [c.split()[0] for c in HEADS.split(", ")]
        known = cut(rows.groupBy("session_id").agg(F.max_by(F.struct(*(c for c in fields if c != "session_id")), "events").alias("h")).select("session_id", "h.*"))
        lacking = self.headers(ids).select("session_id").join(known, "session_id", "left_anti")
        return known if lacking.isEmpty() else known.unionByName(heads_of(self.events(lacking)))

    def readable(self, ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        """(events, faults): what can be read, and faults(session_id, expected, found) of logs with fewer or more events than their heads say."""
        events = self._read("events", EVENTS, ids, damaged=True)
        found = events.groupBy("session_id").agg(F.count("*").alias("found"))
        faults = self.heads(ids).select("session_id", F.col("events").alias("expected")).join(found, "session_id", "left").withColumn("found", F.coalesce("found", F.lit(0).cast("long")))
        return events, faults.where("expected <> found")

    def append(self, events: DataFrame, headers: DataFrame, heads: DataFrame | None = None) -> None:
        """Adds events, headers and the logs' new heads, then names their batch; what a broken append wrote is never read, so it can be repeated."""
        batch = uuid.uuid4().hex
        for name, df in (("events", events), ("headers", headers), *([("heads", heads)] if heads is not None else [])):
            dealt = df.withColumns({"batch": F.lit(batch), "bucket": bucket_of()}).repartition("bucket", F.pmod(F.xxhash64("session_id", F.lit(1)), F.lit(8)))
            dealt.write.mode("append").partitionBy("batch", "bucket").parquet(f"{self.root}/{name}")
        if self.guard is not None:
            self.guard()
        path, fs = self._fs(f"{self.root}/batches/{batch}")
        fs.create(path, False).close()


class MemorySink:
    """Logs as DataFrames, for tests; an append must go on where a log ends, a new log must be new."""

    kind = "memory"

    def __init__(self, spark: SparkSession, format_version: int = 0):
        self.spark, self.format_version = spark, format_version
        self._events, self._headers = spark.createDataFrame([], EVENTS), spark.createDataFrame([], schema.HEADERS)

    def events(self, ids: DataFrame | None = None) -> DataFrame:
        return self._events if ids is None else self._events.join(ids, "session_id", "left_semi")

    def headers(self, ids: DataFrame | None = None) -> DataFrame:
        return self._headers if ids is None else self._headers.join(ids, "session_id", "left_semi")

    def heads(self, ids: DataFrame | None = None) -> DataFrame:
        return heads_of(self.events(ids))

    def readable(self, ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        return self.events(ids), self.spark.createDataFrame([], "session_id string, expected bigint, found bigint")

    def append(self, events: DataFrame, headers: DataFrame, heads: DataFrame | None = None) -> None:
        starts = events.groupBy("session_id").agg(F.min("seq").alias("start"))
        lengths = self._events.groupBy("session_id").agg(F.count("*").alias("length"))
        wrong = starts.join(lengths, "session_id", "left").where(F.col("start") != F.coalesce("length", F.lit(0)))
        if not wrong.isEmpty():
            raise ValueError("an append must start where the stored log ends")
        if not headers.join(self._headers, "session_id", "left_semi").isEmpty():
            raise ValueError("the log is there already")
        rows = lambda a, b: b.unionByName(cut(a.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in b.schema])))
        # both are cut before either is kept, as they can be read from what is stored
        self._headers, self._events = rows(headers, self._headers), rows(events, self._events)


def merged_registry(old: DataFrame, new: DataFrame) -> DataFrame:
    """The registry with new records in place of old ones of the same source and variant; the first import time stays."""
    key = ["source_id", "variant"]
    first = old.select(*key, F.col("first_imported_at").alias("_first"))
    updated = new.join(first, key, "left").withColumn("first_imported_at", F.coalesce("_first", "first_imported_at", "imported_at")).drop("_first")
    return old.join(new.select(key), key, "left_anti").unionByName(updated.select(old.columns))


def records(decided: DataFrame, plan_digests: DataFrame, headers: DataFrame, sessions: DataFrame, counts: DataFrame, now: int, variant: str = "") -> DataFrame:
    """Registry records of a run: skipped sessions are brought up to date too; a conflict keeps the digests out."""
    rows = decided.join(headers.select("session_id", "target_id", "cwd"), "session_id").join(sessions.select("session_id", "title", F.col("updated_at").alias("source_updated_at")), "session_id").join(plan_digests, "session_id", "left").join(counts, "session_id", "left")
    return rows.select(
        F.col("session_id").alias("source_id"), "target_id", F.lit(variant).alias("variant"), "title", "cwd", F.lit(now).cast("long").alias("imported_at"), F.lit(now).cast("long").alias("first_imported_at"), F.col("mode").alias("last_mode"),
        F.col("message_count").alias("source_message_count"), "source_updated_at", F.when(F.col("mode") != "conflict", F.coalesce("turn_digests", F.array().cast("array<string>"))).alias("turn_digests"), F.lit(DIGEST_VERSION).alias("digest_version"),
        F.col("event_count").cast("long").alias("event_count"), F.col("warning_count").cast("long").alias("warning_count"), F.col("reason").alias("conflict_reason"), F.col("turn_index").cast("long").alias("conflict_turn"),
    )


class Registry:
    """Records in Parquet generations; a save writes a new one and then moves the pointer, so a broken save leaves the old."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root.rstrip('/')}/registry"
        self._checked: dict[int, str] = {}

    def _fs(self, path: str):
        made = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return made, made.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _generations(self) -> list[int]:
        path, fs = self._fs(self.root)
        if not fs.exists(path):
            return []
        done = (f.getPath() for f in fs.listStatus(path))
        return sorted(int(p.getName()[1:]) for p in done if p.getName()[1:].isdigit() and fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def unreadable(self) -> str:
        """What is wrong with the footers of the latest generation's files; empty if nothing is."""
        found = self._generations()
        if not found:
            return ""
        if found[-1] not in self._checked:
            try:
                there = self.spark.read.option("mergeSchema", "true").parquet(f"{self.root}/g{found[-1]}").columns
                lacking = [c.split()[0] for c in schema.REGISTRY.split(", ") if c.split()[0] not in there]
                self._checked[found[-1]] = f"no columns {', '.join(lacking)}" if lacking else ""
            except (PySparkException, Py4JError) as error:
                self._checked[found[-1]] = str(error).partition("\n")[0] or "unreadable"
        return self._checked[found[-1]]

    def load(self) -> DataFrame:
        """The records; none if there is no registry or it is unreadable, as stored logs tell themselves what they hold."""
        found = self._generations()
        if not found or self.unreadable():
            return self.spark.createDataFrame([], schema.REGISTRY)
        return self.spark.read.schema(schema.REGISTRY).parquet(f"{self.root}/g{found[-1]}")

    def save(self, records: DataFrame) -> None:
        found = self._generations()
        records.write.parquet(f"{self.root}/g{found[-1] + 1 if found else 1}")
