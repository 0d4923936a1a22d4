"""Checking that reasoning text survived unchanged, and records against logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import DIGEST_VERSION, sha256, utf16_length


def source_reasoning(parts: DataFrame, session: str = "session_id") -> DataFrame:
    """(session, position, text): a source's non-empty reasoning texts in order."""
    order = Window.partitionBy(session).orderBy("msg_pos", "part_pos")
    return parts.where("kind = 'reasoning' and text <> ''").select(session, (F.row_number().over(order) - 1).alias("position"), "text")


def stored_reasoning(events: DataFrame, session: str = "session_id") -> DataFrame:
    """(session, position, text): a log's reasoning blocks in order."""
    rows = events.where("type = 'assistant/message'").select(session, "seq", F.posexplode("blocks").alias("i", "b")).where("b.type = 'reasoning'")
    order = Window.partitionBy(session).orderBy("seq", "i")
    return rows.select(session, (F.row_number().over(order) - 1).alias("position"), F.col("b.text").alias("text"))


def fidelity(source: DataFrame, stored: DataFrame, session: str = "session_id") -> DataFrame:
    """One row a session with reasoning on a side: ok, block counts, stored UTF-16 length, first mismatch.

    mismatch_index is -1 if the counts differ. Texts are compared by length and
    SHA-256, so that only digests are shuffled; heads are kept for the report.
    """
    side = lambda df, n: df.select(session, "position", sha256(F.col("text")).alias(f"{n}_digest"), utf16_length(F.col("text")).alias(f"{n}_chars"), F.substring("text", 1, 60).alias(f"{n}_head"))
    both = side(source, "source").join(side(stored, "stored"), [session, "position"], "full")
    differs = ~F.col("source_digest").eqNullSafe(F.col("stored_digest"))
    rows = both.groupBy(session).agg(
        F.count("source_digest").alias("source_blocks"),
        F.count("stored_digest").alias("stored_blocks"),
        F.coalesce(F.sum("stored_chars"), F.lit(0)).alias("chars"),
        F.min_by(F.struct("position", "source_chars", "stored_chars", "source_head", "stored_head"), F.when(differs, F.col("position"))).alias("m"),
    )
    count_differs = F.col("source_blocks") != F.col("stored_blocks")
    wrong = count_differs | F.col("m").isNotNull()
    return rows.select(
        session,
        (~wrong).alias("ok"),
        "source_blocks",
        "stored_blocks",
        "chars",
        F.when(count_differs, -1).otherwise(F.col("m.position")).cast("long").alias("mismatch_index"),
        F.when(count_differs, "count-differs").when(wrong, "text-differs").alias("mismatch_reason"),
        F.when(~count_differs, F.col("m.source_head")).alias("source_head"),
        F.when(~count_differs, F.col("m.stored_head")).alias("stored_head"),
    )


def verified(records: DataFrame, stored: DataFrame, planned: DataFrame, checked: DataFrame | None = None, session: str = "session_id") -> DataFrame:
    """One row a registry record: whether its log matches it, and how far the source has moved on.

    records(session, turn_digests, digest_version), stored and planned(session,
    turn_digests). A record of the current digest scheme is checked against its own
    digests, an older one against the start of the plan. drift is the plan's
    turns less the record's. fidelity is taken from checked(session, ok) only
    where the source hasn't moved on and the prefix is intact.
    """
    rows = records.select(session, F.coalesce("turn_digests", F.array().cast("array<string>")).alias("recorded"), F.coalesce(F.col("digest_version") == DIGEST_VERSION, F.lit(False)).alias("current"))
    rows = rows.join(stored.select(session, F.col("turn_digests").alias("log")), session, "left").join(planned.select(session, F.col("turn_digests").alias("plan")), session, "left")
    starts = lambda a, b: (F.size(a) <= F.size(b)) & (F.slice(b, F.lit(1), F.greatest(F.size(a), F.lit(0))) == a)
    log = F.coalesce("log", F.array().cast("array<string>"))
    matches_plan = F.coalesce(F.col("plan").isNotNull() & starts(log, F.col("plan")), F.lit(False))
    least = F.least(F.size("recorded"), F.size("plan"))
    intact = F.when(F.col("plan").isNull(), True).when(F.col("current"), F.slice("recorded", F.lit(1), least) == F.slice("plan", F.lit(1), least)).otherwise(matches_plan)
    drift = F.when(F.col("plan").isNotNull(), F.size("plan") - F.size("recorded")).otherwise(0)
    rows = rows.select(
        session,
        F.when(F.col("current"), F.col("log").isNotNull() & (log == F.col("recorded"))).otherwise(matches_plan).alias("ok"),
        (~F.col("current")).alias("legacy_record"),
        F.size(log).cast("long").alias("stored_turns"),
        F.size("recorded").cast("long").alias("recorded_turns"),
        drift.cast("long").alias("drift"),
        intact.alias("prefix_intact"),
    )
    if checked is None:
        return rows.withColumn("fidelity", F.lit(None).cast("boolean"))
    return rows.join(checked.select(session, F.col("ok").alias("_ok")), session, "left").withColumn("fidelity", F.when((F.col("drift") <= 0) & F.col("prefix_intact"), F.coalesce("_ok", F.lit(True)))).drop("_ok")
