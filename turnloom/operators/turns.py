"""Turns and steps over ordered messages.

Everything runs in windows partitioned by session and ordered by msg_pos, so one
shuffle by session serves all. Turn segments and steps are counted with running
sums; no session is collected. Where segment_rows is given, sessions are cut into
segments of so many positions (see scan), so that an endless session is spread over
tasks; the results are the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scan

#: Part kinds that make an assistant message a step.
STEP_KINDS = ("step-start", "reasoning", "text", "tool", "file")


def session_window(session: str = "session_id", position: str = "msg_pos"):
    return Window.partitionBy(session).orderBy(position)


def _so_far(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def anchored_turns(messages: DataFrame, session: str = "session_id", position: str = "msg_pos", anchor: str = "turn_id", name: str = "turn", segment_rows: int | None = None) -> DataFrame:
    """messages plus turn, from 1 up: groups by anchor, in the order of their first messages.

    A message without an anchor (null or empty) joins the group touched last;
    leading ones form a group of their own. An anchor that comes back rejoins
    its group.
    """
    own = F.when(F.col(anchor) != "", F.col(anchor))
    if segment_rows:
        rows = scan.running(messages, [session], scan.segment_of(position, segment_rows), position, lasts={"_last": own}).withColumn("_key", F.coalesce(own, "_last")).drop("_last")
        # groups are numbered by their heads alone, one row each
        heads = rows.groupBy(session, "_key").agg(F.min(position).alias("_first"))
        heads = scan.running(heads, [session], scan.segment_of("_first", segment_rows), "_first", sums={"_n": F.lit(1).cast("long")})
        heads = heads.select(F.col(session).alias("_s"), F.col("_key").alias("_k"), (F.col("_n") + 1).alias("_turn"))
        both = rows.join(heads, (F.col(session) == F.col("_s")) & F.col("_key").eqNullSafe(F.col("_k")))
        return both.withColumn(name, F.col("_turn")).drop("_s", "_k", "_key", "_turn")
    order = session_window(session, position)
    key = F.last(own, ignorenulls=True).over(_so_far(order))
    rows = messages.withColumn("_key", key)
    first = F.min(position).over(Window.partitionBy(session, "_key"))
    rows = rows.withColumn("_first", first)
    return rows.withColumn(name, F.dense_rank().over(Window.partitionBy(session).orderBy("_first")).cast("long")).drop("_key", "_first")


def segment_turns(messages: DataFrame, session: str = "session_id", position: str = "msg_pos", role: str = "role", name: str = "turn", segment_rows: int | None = None) -> DataFrame:
    """messages plus turn, from 1 up, for sources without anchors.

    A user message after an assistant message opens the next turn; following user
    messages stay in it. Other roles neither open turns nor count as answers.
    """
    speaks = F.when(F.col(role).isin("user", "assistant"), F.col(role))
    if segment_rows:
        segment = scan.segment_of(position, segment_rows)
        rows = scan.running(messages, [session], segment, position, lasts={"_before": speaks})
        opens = F.coalesce((F.col(role) == "user") & (F.col("_before") == "assistant"), F.lit(False)).cast("long")
        rows = scan.running(rows.withColumn("_opens", opens), [session], segment, position, sums={"_opened": F.col("_opens")})
        return rows.withColumn(name, F.col("_opened") + F.col("_opens") + 1).drop("_before", "_opens", "_opened")
    order = session_window(session, position)
    before = F.last(speaks, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col(role) == "user") & (before == "assistant"), F.lit(False))
    return messages.withColumn("_opens", opens.cast("long")).withColumn(name, F.sum("_opens").over(_so_far(order)) + 1).drop("_opens")


def is_step(role: Column, kinds: Column) -> Column:
    """Whether a message opens a step: an assistant's with a part of a step kind. kinds: array of part kinds."""
    return (role == "assistant") & F.arrays_overlap(kinds, F.array(*(F.lit(k) for k in STEP_KINDS)))


def numbered_steps(messages: DataFrame, session: str = "session_id", position: str = "msg_pos", step_flag: str = "is_step", segment_rows: int | None = None) -> DataFrame:
    """messages plus step (of steps, within the turn), bucket and turn_steps.

    bucket is the step whose events a message belongs to: steps before it plus
    one, so users wait for the next step, and those after the last step come
    behind all steps.
    """
    flag = F.coalesce(F.col(step_flag), F.lit(False)).cast("long")
    if segment_rows:
        steps = messages.groupBy(F.col(session).alias("_s"), F.col("turn").alias("_t")).agg(F.sum(flag).alias("turn_steps"))
        rows = scan.running(messages, [session, "turn"], scan.segment_of(position, segment_rows), position, sums={"_before": flag})
        rows = rows.join(steps, (F.col(session) == F.col("_s")) & (F.col("turn") == F.col("_t"))).drop("_s", "_t").withColumn("bucket", F.col("_before") + 1).drop("_before")
        return rows.withColumn("step", F.when(F.col(step_flag), F.col("bucket"))).select(*(c for c in rows.columns if c not in ("bucket", "turn_steps")), "bucket", "step", "turn_steps")
    order = Window.partitionBy(session, "turn").orderBy(position)
    before = F.coalesce(F.sum(flag).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = messages.withColumn("bucket", before + 1)
    rows = rows.withColumn("step", F.when(F.col(step_flag), F.col("bucket")))
    return rows.withColumn("turn_steps", F.sum(flag).over(Window.partitionBy(session, "turn")))
