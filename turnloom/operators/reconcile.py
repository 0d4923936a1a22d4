"""Deciding what a session's plan adds to its stored log, and cutting the increment.

Turns are compared by content digest and position, for all sessions in one full
join; the texts take no part in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoint import cut
from ..functions.ids import sha256
from .digests import CONTENT_TYPES, content, sliced, turn_slices


def _positions(slices: DataFrame, side: str, session: str) -> DataFrame:
    order = Window.partitionBy(session).orderBy("slice")
    rows = slices.where(~F.col("contentless")).withColumn("position", F.row_number().over(order) - 1)
    return rows.select(session, "position", F.col("digest").alias(f"{side}_digest"), F.col("event_count").alias(f"{side}_count"))


def turn_differences(planned: DataFrame, stored: DataFrame, session: str = "session_id") -> DataFrame:
    """(session, position, planned_digest, planned_count, stored_digest, stored_count): the turns of two slice tables side by side."""
    return _positions(planned, "planned", session).join(_positions(stored, "stored", session), [session, "position"], "full")


def _outside(events: DataFrame, side: str, session: str, title: str) -> DataFrame:
    """The number of events, and what stands outside turns: the content's digest, the number of events, and the title (first or last)."""
    text = F.when(F.col("type").isin(*CONTENT_TYPES), sha256(content(events.columns)))
    rows = sliced(events.select(session, "seq", "type", "title", text.alias("_text")), session)
    outside = F.col("slice").isNull()
    texts = F.transform(F.array_sort(F.collect_list(F.when(outside & F.col("_text").isNotNull(), F.struct("seq", F.col("_text").alias("t"))))), lambda e: e["t"])
    pick = F.max_by if title == "last" else F.min_by
    return rows.groupBy(session).agg(
        F.count("*").alias(f"{side}_events"), F.array_join(texts, "").alias(f"{side}_prelude"), F.count_if(outside).alias(f"{side}_outside"), pick("title", F.when(outside & (F.col("type") == "session/title"), F.col("seq"))).alias(f"{side}_title")
    )


def decisions(planned: DataFrame, planned_headers: DataFrame, stored: DataFrame, stored_headers: DataFrame, session: str = "session_id") -> DataFrame:
    """One row a planned session: mode, reason and how much of plan and store is consumed.

    Modes, the first that holds: create (no stored header), append (an empty
    stored log), conflict (prelude-differs, source-shrank,
    turn-content-rewritten with its position, header-created-at-differs,
    header-cwd-differs), skip (nothing new), append. Of several stored titles the last
    counts, so a renamed session is not renamed again at each run.
    """
    # each part is made for itself, as one task would hold the sorts of all of them at once
    pairs = turn_differences(cut(turn_slices(planned, session)), cut(turn_slices(stored, session)), session)
    turns = pairs.groupBy(session).agg(
        F.count("planned_digest").alias("planned_turns"),
        F.count("stored_digest").alias("stored_turns"),
        F.min(F.when(~F.col("planned_digest").eqNullSafe(F.col("stored_digest")) & F.col("stored_digest").isNotNull(), F.col("position"))).alias("rewritten_at"),
        F.coalesce(F.sum(F.when(F.col("stored_digest").isNotNull(), F.col("planned_count"))), F.lit(0)).alias("matched_events"),
    )
    head = lambda df, side: df.select(session, F.lit(True).alias(f"{side}_there"), F.col("created_at").alias(f"{side}_created"), F.col("cwd").alias(f"{side}_cwd"))
    rows = head(planned_headers, "planned").join(head(stored_headers, "stored"), session, "left")
    for part in (turns, _outside(planned, "planned", session, "first"), _outside(stored, "stored", session, "last")):
        rows = rows.join(cut(part), session, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = rows.withColumn("title_changed", F.col("planned_title").isNotNull() & ~F.col("planned_title").eqNullSafe(F.col("stored_title")))
    consumed = zero("planned_outside") + zero("matched_events")
    reason = (
        F.when(text("planned_prelude") != text("stored_prelude"), "prelude-differs")
        .when(zero("stored_turns") > zero("planned_turns"), "source-shrank")
        .when(F.col("rewritten_at").isNotNull(), "turn-content-rewritten")
        .when(F.col("stored_created") != F.col("planned_created"), "header-created-at-differs")
        .when(F.col("stored_cwd") != F.col("planned_cwd"), "header-cwd-differs")
    )
    fresh, empty = F.col("stored_there").isNull(), zero("stored_events") == 0
    mode = F.when(fresh, "create").when(empty, "append").when(reason.isNotNull(), "conflict").when((consumed >= zero("planned_events")) & ~F.col("title_changed"), "skip").otherwise("append")
    whole = fresh | empty
    return rows.select(
        session,
        mode.alias("mode"),
        F.when(mode == "conflict", reason).alias("reason"),
        F.when((mode == "conflict") & (reason == "turn-content-rewritten"), F.col("rewritten_at")).alias("turn_index"),
        zero("planned_turns").alias("planned_turns"),
        zero("stored_turns").alias("stored_turns"),
        F.when(whole, 0).otherwise(consumed).cast("long").alias("consumed"),
        F.when(whole, 0).otherwise(zero("stored_events")).cast("long").alias("start_seq"),
        (F.col("title_changed") & ~whole & (mode == "append")).alias("title_changed"),
    )


def restamped(events: DataFrame, start: str, session: str = "session_id", order: str = "_order") -> DataFrame:
    """events numbered again from the session's start, by order; references inside the batch follow, others stay."""
    w = Window.partitionBy(session).orderBy(order)
    rows = events.withColumn("_new", F.row_number().over(w) - 1 + F.col(start))
    refs = rows.where(F.size("source_event_seqs") > 0).select(session, F.col("seq").alias("_at"), F.posexplode("source_event_seqs").alias("_i", "_ref"))
    numbers = rows.select(session, F.col("seq").alias("_ref"), F.col("_new").alias("_to"))
    mapped = refs.join(numbers, [session, "_ref"], "left").groupBy(session, F.col("_at").alias("seq")).agg(F.array_sort(F.collect_list(F.struct("_i", F.coalesce("_to", "_ref").alias("r")))).alias("_refs"))
    # made for itself, as one task would hold the sorts of all three numberings at once
    rows = rows.join(cut(mapped), [session, "seq"], "left")
    return rows.withColumn("source_event_seqs", F.when(F.col("_refs").isNotNull(), F.transform("_refs", lambda x: x["r"].cast("long"))).otherwise(F.col("source_event_seqs"))).withColumn("seq", F.col("_new").cast("long")).drop("_new", "_refs", order, start)


def increments(planned: DataFrame, decided: DataFrame, session: str = "session_id") -> DataFrame:
    """The events to write: whole plans for create, plan tails for append, a changed title first.

    The tail is cut by the plan's own counts and numbered from the stored log's length.
    """
    chosen = decided.where(F.col("mode").isin("create", "append")).select(session, "consumed", "start_seq", "title_changed")
    tail = planned.join(chosen, session).where("seq >= consumed").withColumn("_order", F.col("seq"))
    title = planned.where("type = 'session/title'").join(chosen.where("title_changed"), session).where("seq < consumed").withColumn("_order", F.lit(-1).cast("long"))
    both = tail.unionByName(title).drop("consumed", "title_changed")
    return restamped(both, "start_seq", session)
