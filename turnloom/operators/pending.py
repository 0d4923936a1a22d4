"""Which sessions a run has to take, from the inventory, the registry and the store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pending(inventory: DataFrame, registry: DataFrame, stored_headers: DataFrame | None = None, force: bool = False) -> DataFrame:
    """inventory plus state: new, moved, missing, blocked or done; all are new if forced.

    A session without a record is new, one whose record has a conflict blocked; else it has
    moved if its update time differs from the record's, and is missing if the
    store, where it can be listed, lacks its log.
    """
    records = registry.where("variant = ''").select(F.col("source_id").alias("session_id"), F.col("target_id").alias("_target"), "source_updated_at", F.col("conflict_reason").isNotNull().alias("_blocked"), F.lit(True).alias("_known"))
    rows = inventory.join(records, "session_id", "left")
    if stored_headers is not None:
        there = stored_headers.select(F.col("target_id").alias("_target"), F.lit(True).alias("_there")).distinct()
        rows = rows.join(there, "_target", "left")
    else:
        rows = rows.withColumn("_there", F.lit(True))
    moved = ~F.col("source_updated_at").eqNullSafe(F.col("updated_at"))
    state = F.when(F.col("_known").isNull() | F.lit(force), "new").when(F.col("_blocked"), "blocked").when(moved, "moved").when(F.col("_there").isNull(), "missing").otherwise("done")
    return rows.withColumn("state", state).select(*inventory.columns, "state")


def taken(rows: DataFrame, most: int = 0) -> DataFrame:
    """The pending sessions, latest first; at most `most` of them unless that is 0."""
    ordered = rows.where(F.col("state").isin("new", "moved", "missing")).orderBy(F.desc("updated_at"), "session_id")
    return ordered.limit(most) if most > 0 else ordered


def matching(inventory: DataFrame, wanted: str) -> DataFrame:
    """The session of this id, else the first whose id ends so, in the inventory's order."""
    rank = F.when(F.col("session_id") == wanted, 0).otherwise(1)
    return inventory.where(F.col("session_id").endswith(wanted)).orderBy(rank, F.desc("updated_at"), "session_id").limit(1)
