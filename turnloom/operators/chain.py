"""Chained turn digests: a log's head tells whether a plan goes on from it, without the log being read.

A turn's chain value is hashed from the one before and the turn's digest, so equal
values at a position mean equal turns up to it. A log's head is its last value; it
is kept beside the log's header. A plan whose value at the head's position equals the
head goes on from the log (or adds nothing); only where it differs is
the log read, to find the first turn that differs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoint import cut
from ..functions.ids import sha256
from .digests import CONTENT_TYPES, content, sliced, turn_slices
from .reconcile import turn_differences

#: Turns that are chained in one cell; blocks of them are chained in turn.
BLOCK = 256
HEADS = "session_id string, turns bigint, head string, events bigint, prelude string, title string"


def _chain(digests: Column) -> Column:
    """For an array of digests, the chain value at each."""
    chain = F.aggregate(digests, F.array(F.lit("")), lambda a, d: F.concat(a, F.array(sha256(F.concat(F.element_at(a, -1), d)))))
    return F.slice(chain, F.lit(2), F.size(digests))


def chained(slices: DataFrame, session: str = "session_id") -> DataFrame:
    """(session, position, digest, chain, event_count, events_to) of turns with content, from 0; events_to counts their events up to the turn's end."""
    order = Window.partitionBy(session).orderBy("slice")
    to = F.sum("event_count").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = slices.where(~F.col("contentless")).select(session, (F.row_number().over(order).cast("long") - 1).alias("position"), "digest", "event_count", to.alias("events_to"))
    fields = ("position", "digest", "event_count", "events_to")
    blocks = rows.groupBy(session, F.floor(F.col("position") / BLOCK).alias("block")).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("turns"))
    blocks = blocks.withColumn("inner", _chain(F.transform("turns", lambda t: t["digest"])))
    ends = blocks.groupBy(session).agg(F.array_sort(F.collect_list(F.struct("block", F.element_at("inner", -1).alias("end")))).alias("ends"))
    before = ends.select(session, F.posexplode(F.concat(F.array(F.lit("")), _chain(F.transform("ends", lambda e: e["end"])))).alias("_block", "start"))
    both = blocks.join(before.withColumnRenamed("_block", "block"), [session, "block"])
    value = lambda i: F.when(F.col("block") == 0, F.get("inner", i)).otherwise(sha256(F.concat("start", F.get("inner", i))))
    one = F.transform("turns", lambda t, i: F.struct(*(t[n].alias(n) for n in fields), value(i).alias("chain")))
    return both.select(session, F.explode(one).alias("t")).select(session, "t.position", "t.digest", "t.chain", "t.event_count", "t.events_to")


def heads(log: DataFrame, chain: DataFrame, title: str = "first", session: str = "session_id", segment_rows: int | None = None) -> DataFrame:
    """One row a session with events: turns, head, events, the digest of the content outside turns, and the first or last title.

    chain is chained(turn_slices(log)). A log without turns has the head ''.
    """
    last = chain.groupBy(session).agg(F.count("*").alias("turns"), F.max_by("chain", "position").alias("head"))
    text = F.when(F.col("slice").isNull() & F.col("type").isin(*CONTENT_TYPES), sha256(content(log.columns)))
    said = F.array_sort(F.collect_list(F.when(text.isNotNull(), F.struct("seq", text.alias("t")))))
    pick = F.max_by if title == "last" else F.min_by
    named = F.when(F.col("slice").isNull() & (F.col("type") == "session/title"), F.col("seq"))
    rows = sliced(log, session, segment_rows).groupBy(session).agg(
        F.count("*").alias("events"), F.count_if(F.col("slice").isNull()).alias("outside"), sha256(F.array_join(F.transform(said, lambda e: e["t"]), "")).alias("prelude"), pick("title", named).alias("title")
    )
    rows = rows.join(last, session, "left")
    return rows.select(session, F.coalesce("turns", F.lit(0).cast("long")).alias("turns"), F.coalesce("head", F.lit("")).alias("head"), "events", "outside", "prelude", "title")


def heads_of(log: DataFrame, title: str = "last", session: str = "session_id") -> DataFrame:
    """The heads of stored logs that have none beside them: the logs are read."""
    return heads(log, chained(turn_slices(log, session), session), title, session).select(*(session if c == "session_id" else c for c in (x.split()[0] for x in HEADS.split(", "))))


def decisions(planned: DataFrame, planned_headers: DataFrame, stored_heads: DataFrame, stored_headers: DataFrame, stored: Callable[[DataFrame], DataFrame], session: str = "session_id", segment_rows: int | None = None) -> DataFrame:
    """What reconcile.decisions gives, with planned_events, from the stored logs' heads.

    stored(ids) gives the stored events of some sessions; it is called only if a plan and a head
    differ, and then for these sessions alone.
    """
    slices = cut(turn_slices(planned, session, segment_rows))
    chain = cut(chained(slices, session))
    own = heads(planned, chain, "first", session, segment_rows)
    side = lambda df, name: df.select(session, *(F.col(c).alias(f"{name}_{c}") for c in df.columns if c != session))
    rows = planned_headers.select(session, F.col("created_at").alias("planned_created"), F.col("cwd").alias("planned_cwd"))
    rows = rows.join(side(own, "planned"), session, "left").join(stored_headers.select(session, F.lit(True).alias("stored_there"), F.col("created_at").alias("stored_created"), F.col("cwd").alias("stored_cwd")), session, "left")
    rows = rows.join(side(stored_heads, "stored"), session, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    # where the log ends in the plan, or the plan in the log
    rows = rows.withColumn("_at", F.least(zero("planned_turns"), zero("stored_turns")) - 1)
    here = chain.select(F.col(session).alias("_s"), F.col("position").alias("_p"), F.col("chain").alias("_chain"), F.col("events_to").alias("_events_to"))
    rows = rows.join(here, (F.col(session) == F.col("_s")) & (F.col("_at") == F.col("_p")), "left").drop("_s", "_p")
    goes_on = (zero("stored_turns") == 0) | F.coalesce(F.col("_chain") == F.col("stored_head"), F.lit(False))
    nothing = sha256(F.lit(""))
    renamed = F.col("planned_title").isNotNull() & ~F.col("planned_title").eqNullSafe(F.col("stored_title"))
    reason = (
        F.when(F.coalesce("planned_prelude", nothing) != F.coalesce("stored_prelude", nothing), "prelude-differs")
        .when(zero("stored_turns") > zero("planned_turns"), "source-shrank")
        .when(~goes_on, "turn-content-rewritten")
        .when(F.col("stored_created") != F.col("planned_created"), "header-created-at-differs")
        .when(F.col("stored_cwd") != F.col("planned_cwd"), "header-cwd-differs")
    )
    fresh, empty = F.col("stored_there").isNull(), zero("stored_events") == 0
    consumed = zero("planned_outside") + zero("_events_to")
    mode = F.when(fresh, "create").when(empty, "append").when(reason.isNotNull(), "conflict").when((consumed >= zero("planned_events")) & ~renamed, "skip").otherwise("append")
    whole = fresh | empty
    decided = cut(
        rows.select(
            session, mode.alias("mode"), F.when(mode == "conflict", reason).alias("reason"), zero("planned_turns").alias("planned_turns"), zero("stored_turns").alias("stored_turns"), F.when(whole, 0).otherwise(consumed).cast("long").alias("consumed"),
            F.when(whole, 0).otherwise(zero("stored_events")).cast("long").alias("start_seq"), (renamed & ~whole & (mode == "append")).alias("title_changed"), zero("planned_events").alias("planned_events"),
        )
    )
    rewritten = decided.where("reason = 'turn-content-rewritten'").select(session)
    at = F.lit(None).cast("long")
    if not rewritten.isEmpty():
        pairs = turn_differences(slices.join(rewritten, session, "left_semi"), turn_slices(stored(rewritten), session), session)
        differ = ~F.col("planned_digest").eqNullSafe(F.col("stored_digest")) & F.col("stored_digest").isNotNull()
        decided = decided.join(pairs.groupBy(session).agg(F.min(F.when(differ, F.col("position"))).cast("long").alias("_found")), session, "left")
        at = F.col("_found")
    return decided.withColumn("turn_index", at).select(session, "mode", "reason", "turn_index", "planned_turns", "stored_turns", "consumed", "start_seq", "title_changed", "planned_events")


def written_heads(planned: DataFrame, decided: DataFrame, session: str = "session_id", segment_rows: int | None = None) -> DataFrame:
    """The heads of the logs that a run creates or appends to: the plan's, with the stored log's events counted in."""
    own = heads(planned, chained(turn_slices(planned, session, segment_rows), session), "first", session, segment_rows)
    rows = own.join(decided.where(F.col("mode").isin("create", "append")).select(session, "consumed", "start_seq", "title_changed"), session)
    events = F.col("start_seq") + F.col("events") - F.col("consumed") + F.col("title_changed").cast("long")
    return rows.withColumn("events", events).select(session, "turns", "head", "events", "prelude", "title")
