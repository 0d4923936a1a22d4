"""Importing what has come in since the last run, by Structured Streaming with availableNow.

New record files are the stream. A batch names the sessions that have moved; these
are planned from the whole source and reconciled like any others, so a batch
that is repeated after a failure skips what it has written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import Config
from ..plans import engine
from ..sinks.lock import Locked, import_lock
from ..sinks.store import ParquetSink, Registry
from ..sources.resolve import from_tables


def follow(spark: SparkSession, config: Config, tables: str, checkpoint: str) -> list[tuple[int, str]]:
    """Imports sessions with new rows under tables/message (Parquet); (batch, outcome) of each batch.

    tables has the folders session, message and part. Outcomes: done, locked.
    Never forces; a conflict stays in the registry for a person to settle.
    """
    outcomes: list[tuple[int, str]] = []
    layout = spark.read.parquet(f"{tables}/message").schema

    def batch(rows: DataFrame, number: int) -> None:
        try:
            with import_lock(f"{config.store}/import.lock", spark=spark) as lease:
                moved = rows.select("session_id").distinct()
                source = from_tables(*(spark.read.parquet(f"{tables}/{t}") for t in ("session", "message", "part")))
                engine.run_import(spark, config, ParquetSink(spark, config.store, config.format_version, lease.check), source, Registry(spark, config.store), moved)
                outcomes.append((number, "done"))
        except Locked:
            outcomes.append((number, "locked"))
            raise

    query = spark.readStream.schema(layout).parquet(f"{tables}/message").writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return outcomes


def auto_import(spark: SparkSession, config: Config) -> engine.Run | None:
    """The boot-time import: off unless the settings say pending; never forces; None if off or locked."""
    if config.auto_import != "pending":
        return None
    try:
        return engine.sync(spark, config)
    except Locked:
        return None
