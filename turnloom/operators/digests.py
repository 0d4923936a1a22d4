"""Turn slices of an event log and their content digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoint import cut
from ..functions.ids import sha256
from . import scan

# Fixed value: the types that carry content; the others are bookkeeping, which a digest leaves out.
CONTENT_TYPES = ("turn/start", "turn/end", "step/start", "step/end", "user/message", "assistant/message", "tool/call", "tool/result")
#: What a digest covers, by name: an event's type and data. seq, time, surface_op, source_event_seqs and stream are left out.
CONTENT_FIELDS = tuple(
    sorted(("type", "turn", "step", "message_id", "role", "blocks", "source_kind", "plugin", "form", "provider", "model", "usage", "call_id", "name", "arguments", "is_error", "error_name", "error_code", "reason_kind", "reason_message", "reason_code", "title"))
)


def content(columns: list[str]) -> Column:
    """An event's content as canonical JSON: fields by name, NULL ones left out."""
    return F.to_json(F.struct(*(F.col(c) for c in CONTENT_FIELDS if c in columns)))


def sliced(events: DataFrame, session: str = "session_id", segment_rows: int | None = None) -> DataFrame:
    """events plus slice: the turn's number in the log, from 1; NULL for what stands outside turns.

    turn/start opens a slice, closing an open one; turn/end closes it. Rows
    before, between and after slices are the prelude. segment_rows spreads an endless session over tasks.
    """
    if segment_rows:
        segment = scan.segment_of("seq", segment_rows)
        begins = (F.col("type") == "turn/start").cast("long")
        rows = scan.running(events, [session], segment, "seq", sums={"_slice": begins}).withColumn("_slice", F.col("_slice") + begins)
        rows = scan.running(rows, [session, "_slice"], segment, "seq", sums={"_over": (F.col("type") == "turn/end").cast("long")})
        return rows.withColumn("slice", F.when((F.col("_slice") > 0) & (F.col("_over") == 0), F.col("_slice"))).drop("_slice", "_over")
    order = Window.partitionBy(session).orderBy("seq")
    upto, before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow), order.rowsBetween(Window.unboundedPreceding, -1)
    number = lambda t, w: F.coalesce(F.sum((F.col("type") == t).cast("long")).over(w), F.lit(0))
    rows = events.withColumns({"_slice": number("turn/start", upto), "_ended": number("turn/end", before)})
    # ends since the last start, from the same sort
    rows = rows.withColumn("_over", F.col("_ended") - F.coalesce(F.last(F.when(F.col("type") == "turn/start", F.col("_ended")), ignorenulls=True).over(upto), F.lit(0)))
    return rows.withColumn("slice", F.when((F.col("_slice") > 0) & (F.col("_over") == 0), F.col("_slice"))).drop("_slice", "_ended", "_over")


def turn_slices(events: DataFrame, session: str = "session_id", segment_rows: int | None = None) -> DataFrame:
    """(session, slice, turn, digest, event_count, contentless) of each turn in the log.

    A digest is the SHA-256 of the content events' texts in order. Each text is
    digested first, so that long cells aren't gathered.
    """
    text = F.when(F.col("type").isin(*CONTENT_TYPES), sha256(content(events.columns)))
    rows = sliced(events.select(session, "seq", "type", "turn", text.alias("_text")), session, segment_rows).where("slice is not null")
    ordered = F.array_sort(F.collect_list(F.when(F.col("_text").isNotNull(), F.struct("seq", "_text"))))
    return rows.groupBy(session, "slice").agg(
        F.min_by("turn", "seq").alias("turn"),
        sha256(F.array_join(F.transform(ordered, lambda e: e["_text"]), "")).alias("digest"),
        F.count("*").alias("event_count"),
        (F.count("_text") == 0).alias("contentless"),
    )


def turn_digests(slices: DataFrame, session: str = "session_id") -> DataFrame:
    """(session, turn_digests): the digests of turns with content, in order."""
    return slices.where(~F.col("contentless")).groupBy(session).agg(F.transform(F.array_sort(F.collect_list(F.struct("slice", "digest"))), lambda s: s["digest"]).alias("turn_digests"))


def log_digest(events: DataFrame, session: str = "session_id") -> DataFrame:
    """(session, digest) of the whole log, every field included. Events are digested first, then dealt over as many tasks as they need."""
    fields = sorted(c for c in events.columns if c not in (session, "seq"))
    rows = cut(events.select(session, "seq", sha256(F.to_json(F.struct("seq", *fields))).alias("_text")))
    rows = scan.dealt(rows, rows.count(), session)
    return rows.groupBy(session).agg(sha256(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "_text"))), lambda e: e["_text"]), "")).alias("digest"))
