"""SQLite tables as a Spark data source, read-only.

    spark.dataSource.register(SqliteSource)
    spark.read.format("sqlite_ro").option("path", file).option("table", "message").load()

The table's columns are probed, as stores differ in them. A table is cut into
ranges of its rowid, or of its primary key's first column if it has none. Their boundaries are existing keys, so
many rows apart, stepped along the key's index: gaps between keys make no partitions. Filters on equality of
a column and lists of its values are pushed into the queries. `columns` reads only those.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from itertools import pairwise
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

#: Rows of one partition, about, and milliseconds to wait for a locked store.
RANGE_ROWS, BUSY_MS = 100_000, 5_000


def connect(path: str, busy_ms: int = BUSY_MS) -> sqlite3.Connection:
    """A read-only connection that can't write."""
    made = sqlite3.connect(f"{Path(path).absolute().as_uri()}?mode=ro", uri=True, timeout=busy_ms / 1000)
    made.execute("PRAGMA query_only = 1")
    return made


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def probe(path: str) -> str | None:
    """None if the store can be read; else database-missing, database-open-failed or schema-unreadable."""
    if not Path(path).is_file():
        return "database-missing"
    try:
        store = connect(path)
    except sqlite3.Error:
        return "database-open-failed"
    try:
        found = {t for t in ("session", "message", "part") if store.execute(f"PRAGMA table_info({t})").fetchall()}
        return None if len(found) == 3 else "schema-unreadable"
    except sqlite3.Error:
        return "schema-unreadable"
    finally:
        store.close()


class Range(InputPartition):
    """Keys from low to before high; None is without a bound."""

    def __init__(self, low, high):
        super().__init__((low, high))
        self.low, self.high = low, high


def key_of(store: sqlite3.Connection, table: str) -> str:
    """What a table's rows are ranged by."""
    try:
        store.execute(f"SELECT rowid FROM {quoted(table)} LIMIT 0")
        return "rowid"
    except sqlite3.OperationalError:
        keys = sorted((r[5], r[1]) for r in store.execute(f"PRAGMA table_info({quoted(table)})") if r[5])
        return quoted(keys[0][1])


def boundaries(store: sqlite3.Connection, table: str, key: str, rows: int) -> list:
    """Existing keys that begin ranges of about so many rows, but for the first range; equal keys stay together."""
    found: list = []
    at = store.execute(f"SELECT min({key}) FROM {quoted(table)}").fetchone()[0]
    while at is not None:
        step = store.execute(f"SELECT {key} FROM {quoted(table)} WHERE {key} >= ? ORDER BY {key} LIMIT 1 OFFSET ?", (at, rows)).fetchone()
        if step and step[0] == at:
            step = store.execute(f"SELECT min({key}) FROM {quoted(table)} WHERE {key} > ?", (at,)).fetchone()
        at = step[0] if step else None
        found += [] if at is None else [at]
    return found


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite_ro"

    def schema(self) -> StructType:
        kinds = {"INT": LongType(), "REAL": DoubleType(), "FLOA": DoubleType(), "DOUB": DoubleType(), "BLOB": BinaryType()}
        wanted = [c for c in self.options.get("columns", "").split(",") if c]
        store = connect(self.options["path"])
        try:
            rows = store.execute(f"PRAGMA table_info({quoted(self.options['table'])})").fetchall()
        finally:
            store.close()
        if not rows:
            raise ValueError(f"no table {self.options['table']}")
        return StructType([StructField(r[1], next((k for n, k in kinds.items() if n in r[2].upper()), StringType())) for r in rows if not wanted or r[1] in wanted])

    def reader(self, schema: StructType) -> DataSourceReader:
        return SqliteReader(schema, self.options)


class SqliteReader(DataSourceReader):
    def __init__(self, schema: StructType, options):
        self.columns = [(f.name, f.dataType) for f in schema]
        self.path, self.table = options["path"], options["table"]
        self.rows = int(options.get("rowsPerPartition", RANGE_ROWS))
        self.busy = int(options.get("busyTimeout", BUSY_MS))
        self.tests: list[tuple[str, list]] = []

    def pushFilters(self, filters) -> Iterator:
        names = {n for n, _ in self.columns}
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in names:
                values = [f.value] if isinstance(f, EqualTo) else list(f.value)
                self.tests.append((f"{quoted(f.attribute[0])} IN ({', '.join('?' * len(values))})", values))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        store = connect(self.path, self.busy)
        try:
            edges = [None, *boundaries(store, self.table, key_of(store, self.table), self.rows), None]
        finally:
            store.close()
        return [Range(a, b) for a, b in pairwise(edges)]

    def read(self, partition: Range) -> Iterator[tuple]:
        store = connect(self.path, self.busy)
        try:
            key = key_of(store, self.table)
            edges = [(f"{key} {sign} ?", v) for sign, v in ((">=", partition.low), ("<", partition.high)) if v is not None]
            where = " AND ".join([t for t, _ in edges] + [t for t, _ in self.tests]) or "1"
            values = [v for _, v in edges] + [v for _, x in self.tests for v in x]
            convert = [self.converter(kind) for _, kind in self.columns]
            for row in store.execute(f"SELECT {', '.join(quoted(n) for n, _ in self.columns)} FROM {quoted(self.table)} WHERE {where}", values):
                yield tuple(None if v is None else f(v) for f, v in zip(convert, row, strict=True))
        finally:
            store.close()

    @staticmethod
    def converter(kind):
        """SQLite columns hold values of any type; one that doesn't fit its column's becomes NULL."""

        def whole(v):
            try:
                return int(v)
            except (TypeError, ValueError):
                return None

        def real(v):
            try:
                return float(v)
            except (TypeError, ValueError):
                return None

        def text(v):
            return v.decode("utf-8", "replace") if isinstance(v, bytes) else str(v)

        return {LongType: whole, DoubleType: real, BinaryType: lambda v: v if isinstance(v, bytes) else str(v).encode()}.get(type(kind), text)


def read_table(spark: SparkSession, path: str, table: str, columns: tuple[str, ...] = ()) -> DataFrame:
    spark.dataSource.register(SqliteSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("sqlite_ro").option("path", path).option("table", table).option("columns", ",".join(columns)).load()


def store_tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The store's session, message and part tables, with the columns that are read."""
    keys = ("id", "session_id", "message_id", "time_created", "data", "sequence")
    return (
        read_table(spark, path, "session", ("id", "title", "directory", "path", "time_created", "time_updated", "project_id", "version", "task_type")),
        read_table(spark, path, "message", keys),
        read_table(spark, path, "part", keys),
    )
