"""Structural rules of an event log, as one query that gives a row for each violation.

The state that a rule looks at (the open turn, the open step, the last number)
is a running window over the session's events, so all rules come from one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoint import cut
from ..functions import json as J
from . import scan

# The vocabulary, and the types that must carry a surface operation.
VOCABULARY = (
    "turn/start", "turn/end", "step/start", "step/end", "user/message", "assistant/chunk", "assistant/message",
    "tool/call", "tool/result", "todo/write", "request/header", "request/context", "session/end-seed", "session/title",
)
SURFACE_TYPES = ("user/message", "assistant/message", "tool/result")
NOT_STARTED = "TOOL_NOT_STARTED"


def _segmented_state(rows: DataFrame, session: str, order_by: str, segment_rows: int) -> DataFrame:
    """with_state, in segments of sessions, so that an endless one is spread over tasks."""
    type_ = F.col("type")
    is_ = lambda t: F.coalesce(type_ == t, F.lit(False)).cast("long")
    # rows without a place in the order come first, as they do in a window
    segment = F.coalesce(scan.segment_of(order_by, segment_rows), F.lit(-1).cast("long"))
    rows = scan.running(
        rows, [session], segment, order_by, sums={"turns_ended": is_("turn/end"), "_turns": is_("turn/start"), "_steps": is_("step/start")}, lasts={"_prev": F.struct("seq"), "_turn_before": F.col("_turn_mark"), "_step_before": F.col("_step_mark")}
    )
    rows = rows.withColumns(
        {
            "prev_seq": F.col("_prev.seq"), "open_turn": F.when(F.col("_turn_before.open"), F.col("_turn_before.n")), "open_step": F.when(F.col("_step_before.open"), F.col("_step_before.n")),
            "_turns": F.col("_turns") + is_("turn/start"), "_steps": F.col("_steps") + is_("step/start"),
        }
    ).drop("_prev", "_turn_before", "_step_before")
    rows = scan.running(rows, [session, "_turns"], segment, order_by, sums={"_ended": is_("step/end")})
    rows = scan.running(rows, [session, "_steps"], segment, order_by, sums={"said": is_("assistant/message")})
    rows = scan.running(rows, [session, "_steps", "call_id"], segment, order_by, lasts={"_call": F.when(type_ == "tool/call", 1).when(type_ == "tool/result", 0)})
    return rows.withColumns({"next_step": F.col("_ended") + 1, "_call_open": F.coalesce("_call", F.lit(0)) == 1}).drop("_ended", "_call", "_turn_mark", "_step_mark")


def with_state(events: DataFrame, session: str = "session_id", segment_rows: int | None = None) -> DataFrame:
    """events plus what stands before each: previous seq, open turn and step, expected numbers, earlier messages and calls.

    The order is that of `pos` if there is one, else of seq.
    """
    order_by = "pos" if "pos" in events.columns else "seq"
    order = Window.partitionBy(session).orderBy(order_by)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    type_ = F.col("type")
    # a bracket's last start or end before the row tells whether it is open, and its number
    turn_mark = F.when(type_ == "turn/start", F.struct(F.lit(True).alias("open"), F.col("turn").alias("n"))).when(type_ == "turn/end", F.struct(F.lit(False).alias("open"), F.col("turn").alias("n")))
    step_mark = F.when(type_ == "step/start", F.struct(F.lit(True).alias("open"), F.col("step").alias("n"))).when(type_ == "step/end", F.struct(F.lit(False).alias("open"), F.col("step").alias("n")))
    rows = events.withColumns({"_turn_mark": turn_mark, "_step_mark": step_mark})
    if segment_rows:
        return _segmented_state(rows, session, order_by, segment_rows)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    number = lambda t, w: F.coalesce(F.sum((type_ == t).cast("long")).over(w), F.lit(0))
    last = lambda c: F.last(c, ignorenulls=True).over(before)
    rows = rows.withColumns(
        {
            "prev_seq": F.lag("seq").over(order),
            "open_turn": F.when(last(F.col("_turn_mark"))["open"], last(F.col("_turn_mark"))["n"]),
            "open_step": F.when(last(F.col("_step_mark"))["open"], last(F.col("_step_mark"))["n"]),
            "turns_ended": number("turn/end", before),
            "_turns": number("turn/start", upto),
            "_steps": number("step/start", upto),
            "_ended": number("step/end", before),
            "_said": number("assistant/message", before),
        }
    )
    # what was counted since the last start is all less what was there at that start, so one sort serves
    since = lambda c, start: F.col(c) - F.coalesce(F.last(F.when(type_ == start, F.col(c)), ignorenulls=True).over(upto), F.lit(0))
    call = Window.partitionBy(session, "_steps", "call_id").orderBy(order_by).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"next_step": since("_ended", "turn/start") + 1, "said": since("_said", "step/start")})
    # a call is a set's member: it counts once until a result takes it out
    called = F.last(F.when(type_ == "tool/call", 1).when(type_ == "tool/result", 0), ignorenulls=True).over(call)
    return rows.withColumn("_call_open", F.coalesce(called, F.lit(0)) == 1).drop("_turn_mark", "_step_mark", "_ended", "_said")


def _own_rules(require_all: bool) -> dict[str, Column]:
    """What is wrong with an event by itself, by rule; _unmet of a result is that it needs an open call."""
    t, c = (lambda *names: F.col("type").isin(*names)), F.col
    differs = lambda a, b: ~a.eqNullSafe(b)
    no_blocks = F.coalesce(F.size("blocks") <= 0, F.lit(True))
    first = F.get("blocks", F.lit(0))
    textless = F.coalesce(F.exists("blocks", lambda b: b["type"].isin("reasoning", "text") & b["text"].isNull()), F.lit(False))
    return {
        "V1": c("type").isNull() | c("seq").isNull() | c("time").isNull(),
        **({"V2": ~t(*VOCABULARY)} if require_all else {}),
        "V4": t(*SURFACE_TYPES) == c("surface_op").isNull(),
        "V6": t("turn/end") & c("reason_kind").isNull(),
        "V9": t("user/message") & (no_blocks | differs(c("role"), F.lit("user"))),
        "V10": t("assistant/message") & (no_blocks | differs(c("source_kind"), F.lit("model")) | c("provider").isNull() | c("model").isNull() | textless),
        "V11": t("tool/call") & c("arguments").isNull(),
        "V12": t("tool/result") & (differs(c("source_kind"), F.lit("tool")) | differs(first["type"], F.lit("tool-result")) | differs(first["id"], c("call_id"))),
        "V13": t("session/title") & F.coalesce(c("title") == "", F.lit(True)),
    }


def _state_rules() -> dict[str, Column]:
    """What is wrong with an event where it stands, by rule."""
    t, c = (lambda *names: F.col("type").isin(*names)), F.col
    differs = lambda a, b: ~a.eqNullSafe(b)
    in_step = ~differs(c("open_turn"), c("turn")) & ~differs(c("open_step"), c("step"))
    return {
        "V3": differs(c("seq"), F.coalesce(c("prev_seq"), F.lit(-1)) + 1),
        "V5": t("turn/start") & (c("open_turn").isNotNull() | differs(c("turn"), c("turns_ended") + 1)),
        "V6": t("turn/end") & (differs(c("open_turn"), c("turn")) | c("open_step").isNotNull()),
        "V7": t("step/start") & (differs(c("open_turn"), c("turn")) | c("open_step").isNotNull() | differs(c("step"), c("next_step"))),
        "V8": t("step/end") & ~in_step,
        "V9": t("user/message") & c("open_turn").isNull(),
        "V10": t("assistant/message") & (~in_step | (c("said") > 0)),
        "V11": t("tool/call") & ~in_step,
        "V12": t("tool/result") & ~c("_call_open") & c("_needs_call"),
    }


def violations(events: DataFrame, session: str = "session_id", require_all: bool = True, segment_rows: int | None = None) -> DataFrame:
    """(session, seq, rule) for every broken rule V1 to V16; none for a sound log.

    V14 is what is open at the end of a log, with its last seq. V8 also names
    calls without results at the step's end. V15, that values are lossless
    JSON, holds by the columns' types; lossy looks for it in stored text. V16 is ours: a tool-call block without a call.
    """
    order = "pos" if "pos" in events.columns else "seq"
    named = lambda rules: F.filter(F.array(*(F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules.items())), lambda r: r.isNotNull())
    asked = F.transform(F.filter("blocks", lambda b: b["type"] == "tool-call"), lambda b: b["id"])
    not_started = F.coalesce(F.get("blocks", F.lit(0))["is_error"], F.lit(False)) & F.coalesce(F.col("error_code") == NOT_STARTED, F.lit(False))
    needs_call = ~not_started & F.coalesce(F.col("surface_op") == "append", F.lit(False))
    # what an event is by itself is looked at first, so that no texts are sorted; then events are dealt by session over as many tasks as they need
    slim = cut(
        events.select(
            session, *dict.fromkeys((order, "seq")), "type", "turn", "step", "call_id", needs_call.alias("_needs_call"), named(_own_rules(require_all)).alias("_own"), F.when(F.col("type") == "assistant/message", asked).alias("asked")
        )
    )
    slim = slim if segment_rows else scan.dealt(slim, slim.count(), session)
    # all branches read the same few columns, which are made once
    rows = cut(
        with_state(slim, session, segment_rows).select(
            session, *dict.fromkeys((order, "seq")), "type", "call_id", "_turns", "_steps", "open_turn", "open_step", F.concat("_own", named(_state_rules())).alias("broken"), "asked"
        )
    )
    simple = rows.select(session, "seq", F.explode("broken").alias("rule"))

    calls = rows.where(F.col("type").isin("tool/call", "tool/result")).groupBy(session, "_turns", "_steps", "call_id").agg(F.max_by(F.col("type"), "seq").alias("last"), F.max("seq").alias("at"))
    waiting = calls.where("last = 'tool/call'")
    ends = rows.where("type = 'step/end'").groupBy(session, "_steps").agg(F.min("seq").alias("seq"))
    unanswered = waiting.join(ends, [session, "_steps"], "left").select(session, F.coalesce("seq", "at").alias("seq"), F.when(F.col("seq").isNotNull(), "V8").otherwise("V14").alias("rule")).distinct()

    final = rows.groupBy(session).agg(F.max_by(F.struct("type", "open_turn", "open_step", "seq"), order).alias("z"))
    turn_left = F.when(F.col("z.type") == "turn/start", True).when(F.col("z.type") == "turn/end", False).otherwise(F.col("z.open_turn").isNotNull())
    step_left = F.when(F.col("z.type") == "step/start", True).when(F.col("z.type") == "step/end", False).otherwise(F.col("z.open_step").isNotNull())
    open_end = final.where(turn_left | step_left).select(session, F.col("z.seq").alias("seq"), F.lit("V14").alias("rule"))

    blocks = rows.where("size(asked) > 0").select(session, "_steps", "seq", F.explode("asked").alias("call_id"))
    made = rows.where("type = 'tool/call'").select(session, "_steps", "call_id").distinct()
    uncalled = blocks.join(made, [session, "_steps", "call_id"], "left_anti").select(session, "seq", F.lit("V16").alias("rule")).distinct()
    return simple.unionByName(unanswered).unionByName(open_end).unionByName(uncalled).distinct()


#: A number that may be too large for a double has an exponent of three digits, or this many digits before it.
OVERSIZED = r"\d[eE]\+?\d{3}|\d{200}"


def _endless(value: Column) -> Column:
    """A variant's text if it is a number that no double can hold, Infinity or -Infinity; else NULL."""
    number = F.when(J.kind(value) == "NUMBER", F.try_variant_get(value, "$", "double"))
    return F.when(F.abs(number) == float("inf"), F.when(number > 0, "Infinity").otherwise("-Infinity"))


def _children(value: Column) -> Column:
    return F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.map_values(F.try_variant_get(value, "$", "map<string,variant>")))


def lossy(events: DataFrame, session: str = "session_id", order: str = "seq", text: str = "data") -> DataFrame:
    """(session, seq, rule, offender): V15, the first event of each session whose data isn't lossless JSON.

    text is a stored event as JSON; its member data must hold, at any depth,
    no number too large for a double, as its reader takes that for infinite. The offender
    is the first member of data, in the order of the text, that is or holds such a number: its key
    and what it is. Texts that aren't JSON or have no data break no rule here, and digits within strings
    are no numbers. Only events in whose text such a number may stand are
    parsed; values are walked one level of nesting at a time.
    """
    # the text is parsed once to find kinds, and once to have the members in their own order
    data = J.at(J.parsed(F.col(text)), "$.data")
    members = F.when(J.kind(data) == "OBJECT", F.map_entries(F.from_json(F.col(text), "data map<string,variant>")["data"])).when(
        J.kind(data) == "ARRAY", F.transform(F.try_variant_get(data, "$", "array<variant>"), lambda v, i: F.struct(i.cast("string").alias("key"), v.alias("value")))
    )
    bare = F.when(_endless(data).isNotNull(), F.array(F.struct(F.lit(None).cast("string").alias("key"), data.alias("value"))))
    suspects = events.where(F.col(text).rlike(OVERSIZED)).select(session, F.col(order).alias("seq"), F.coalesce(members, bare).alias("m"))
    # rows that repeat a number are told apart by their members' places only; any of them breaks the rule
    tops = cut(suspects.select(session, "seq", F.posexplode("m").alias("at", "m")).select(session, "seq", "at", F.col("m.key").alias("key"), F.col("m.value").alias("value")))
    found = tops.select(session, "seq", "at", "key", _endless(F.col("value")).alias("what")).where("what is not null")
    level = tops
    while True:
        level = cut(level.select(session, "seq", "at", "key", F.explode(_children(F.col("value"))).alias("value")))
        if level.isEmpty():
            break
        found = found.unionByName(level.where(_endless(F.col("value")).isNotNull()).select(session, "seq", "at", "key", F.lit("object").alias("what")))
    offender = F.when(F.col("key").isNull(), "unknown member").otherwise(F.concat("key", F.lit(": "), "what"))
    first = found.groupBy(session).agg(F.min(F.struct("seq", "at", offender.alias("offender"))).alias("f"))
    return first.select(session, F.col("f.seq").alias("seq"), F.lit("V15").alias("rule"), F.col("f.offender").alias("offender"))


def log_stats(events: DataFrame, session: str = "session_id") -> DataFrame:
    """The validator's counters of each session."""
    n = lambda *types: F.count_if(F.col("type").isin(*types))
    return events.groupBy(session).agg(
        n("turn/start").alias("turns"),
        n("step/start").alias("steps"),
        n("user/message").alias("user_messages"),
        n("assistant/message").alias("assistant_messages"),
        n("tool/call").alias("tool_calls"),
        n("tool/result").alias("tool_results"),
        n(*SURFACE_TYPES).alias("surface_events"),
    )
