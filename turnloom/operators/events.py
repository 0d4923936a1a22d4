"""Deriving a session's ordered event log from its messages and parts.

A message stands for known events: the turn's start before its first message, the
step with its calls and results, the turn's end after its last. So turns, steps and every
event's number are found from a few narrow columns of the messages (`_placed`), which are joined to the
messages and their parts. A message is exploded to the types and numbers of its events, and an event's
fields are taken from the message after that: events are never sorted, and fields that nobody asks for aren't made.
Messages and parts are dealt by session over as many tasks as they need.

Where segment_rows is given, nothing is partitioned by session alone: turns and
steps are scanned in segments (see scan), and a turn's facts are aggregated and joined,
so an endless session or turn is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoint import cut
from ..functions import ids as I
from . import scan
from . import turns as T

BLOCK = "struct<type:string,text:string,id:string,name:string,arguments:string,is_error:boolean>"
USAGE = "struct<cache_read:bigint,cache_write:bigint,input:bigint,output:bigint,reasoning:bigint>"
STREAM = "array<struct<kind:string,time0:bigint,index:int,dt:array<bigint>,texts:array<string>,id:string,name:string>>"
#: Columns of an event besides session_id, seq, source_event_seqs and the sort key.
FIELDS = {
    "type": "string",
    "time": "bigint",
    "turn": "bigint",
    "step": "bigint",
    "surface_op": "string",
    "message_id": "string",
    "role": "string",
    "blocks": f"array<{BLOCK}>",
    "source_kind": "string",
    "plugin": "string",
    "form": "string",
    "provider": "string",
    "model": "string",
    "usage": USAGE,
    "stream": STREAM,
    "call_id": "string",
    "name": "string",
    "arguments": "string",
    "is_error": "boolean",
    "error_name": "string",
    "error_code": "string",
    "reason_kind": "string",
    "reason_message": "string",
    "reason_code": "string",
    "title": "string",
}
#: Texts that stand for what has none. They are ours; only where they stand is given.
EMPTY_MESSAGE, EMPTY_OUTPUT = "(no content)", "(no output)"
PLUGIN = "importer"
# Fixed values of the log format.
OUTCOME_UNKNOWN = ("ToolOutcomeUnknownError", "TOOL_OUTCOME_UNKNOWN")
FINISHED = ("stop", "tool-calls", "completed", "stream_recovery_discarded")


def _block(kind: str, **fields: Column) -> Column:
    names = ("text", "id", "name", "arguments", "is_error")
    return F.struct(F.lit(kind).alias("type"), *(fields.get(n, F.lit(None)).cast("boolean" if n == "is_error" else "string").alias(n) for n in names))


def tool_arguments(input_: Column, kind: Column) -> tuple[Column, Column]:
    """(arguments, how): a string holding a JSON object or array as it is; other strings wrapped; {} for none; else the JSON text."""
    variant = F.schema_of_variant(F.try_parse_json(F.trim(input_)))
    valid = F.coalesce(variant.startswith("OBJECT") | variant.startswith("ARRAY"), F.lit(False))
    how = F.when(input_.isNull() | kind.isNull(), "absent").when(kind != "STRING", "reserialized").when(valid, "verbatim").otherwise("wrapped")
    text = F.when(how == "absent", "{}").when(how == "wrapped", F.to_json(F.struct(input_.alias("_raw")))).otherwise(input_)
    return text, how


def tool_outcome(status: Column, output: Column, error: Column) -> tuple[Column, Column, Column]:
    """(text, is_error, synthetic) of a tool part."""
    open_ = status.isin("running", "pending")
    failed = status == "error"
    raw = F.when(failed, F.coalesce(error, output, F.lit(""))).otherwise(F.coalesce(output, F.lit("")))
    text = F.when(open_, F.concat(F.lit("No result was recorded for this call (status: "), status, F.lit("); its outcome is unknown."))).otherwise(F.when(raw == "", EMPTY_OUTPUT).otherwise(raw))
    return text, open_ | failed, open_


def file_placeholder(mime: Column, size: Column, url: Column) -> Column:
    note = F.coalesce(F.concat(F.lit(", "), size.cast("string"), F.lit(" B")), F.lit(""))
    return F.concat(F.lit("[attachment: "), F.coalesce(mime, F.lit("unknown type")), note, F.lit("]"), F.coalesce(F.concat(F.lit(" "), url), F.lit("")), F.lit(" (content not migrated)"))


def turn_end_reason(finish: Column) -> tuple[Column, Column, Column]:
    """(kind, message, code) for the last finish of a turn's content-producing steps."""
    kind = F.when(finish == "length", "max-tokens").when(finish == "failed", "error").otherwise("completed")
    failed = finish == "failed"
    return kind, F.when(failed, "the source recorded finish=failed"), F.when(failed, "UNKNOWN")


def _stream(blocks: Column, time: Column) -> Column:
    """One record for each block, in one piece, as its timing isn't known."""
    one = lambda b, i: F.struct(
        F.when(b["type"] == "tool-call", "tool-call-chunks").when(b["type"] == "reasoning", "reasoning-chunks").otherwise("text-chunks").alias("kind"),
        time.alias("time0"),
        i.alias("index"),
        F.array().cast("array<bigint>").alias("dt"),
        F.array(F.coalesce(b["arguments"], b["text"])).alias("texts"),
        b["id"].alias("id"),
        b["name"].alias("name"),
    )
    return F.transform(blocks, one)


def planned_messages(sessions: DataFrame, messages: DataFrame, parts: DataFrame, anchored: bool = True, segment_rows: int | None = None) -> DataFrame:
    """Messages with their parts as an ordered array, turn, step and bucket, the session's fields, and what `_placed` finds."""
    tool_text, tool_error, tool_open = tool_outcome(F.col("status"), F.col("output"), F.col("error"))
    arguments, how = tool_arguments(F.col("input"), F.col("input_kind"))
    tool = lambda c: F.when(F.col("kind") == "tool", c)
    keys, rows = (("session_id", "msg_pos") if segment_rows else ("session_id",)), messages.count()
    slim = scan.dealt(parts, rows, *keys).select(
        "session_id",
        "msg_pos",
        F.struct(
            "part_pos",
            "kind",
            "id",
            "time",
            F.when(F.col("kind") == "file", file_placeholder(F.col("mime"), F.col("size_bytes"), F.col("url"))).otherwise(F.col("text")).alias("text"),
            tool(F.coalesce("call_id", F.concat(F.lit("call-"), "id"))).alias("call_id"),
            "tool_name",
            tool(arguments).alias("arguments"),
            tool(how).alias("how"),
            tool(tool_text).alias("result"),
            tool(tool_error).alias("is_error"),
            tool(tool_open).alias("open"),
            "status",
            "tool_end_time",
        ).alias("part"),
    )
    nested = slim.groupBy("session_id", "msg_pos").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    placed = _placed(messages, parts, anchored, segment_rows, rows)
    both = scan.dealt(messages, rows, *keys).join(nested, ["session_id", "msg_pos"], "left").join(placed, ["session_id", "msg_pos"])
    both = both.withColumn("parts", F.coalesce("parts", F.array().cast(nested.schema["parts"].dataType)))
    both = both.withColumn("is_step", T.is_step(F.col("role"), F.transform("parts", lambda p: p["kind"])))
    about = sessions.select("session_id", F.col("created_at").alias("session_created"), F.col("model").alias("session_model"), F.col("provider").alias("session_provider"), F.col("title").alias("session_title"))
    return both.join(about, "session_id")


def _assistant_blocks(parts: Column) -> Column:
    kept = F.filter(parts, lambda p: (p["kind"].isin("reasoning", "text") & (p["text"] != "")) | p["kind"].isin("tool", "file"))
    return F.transform(
        kept,
        lambda p: F.when(p["kind"] == "tool", _block("tool-call", id=p["call_id"], name=p["tool_name"], arguments=p["arguments"]))
        .when(p["kind"] == "reasoning", _block("reasoning", text=p["text"]))
        .otherwise(_block("text", text=p["text"])),
    )


def _user_blocks(parts: Column) -> Column:
    kept = F.filter(parts, lambda p: ((p["kind"] == "text") & (p["text"] != "")) | (p["kind"] == "file"))
    blocks = F.transform(kept, lambda p: _block("text", text=p["text"]))
    return F.when(F.size(blocks) > 0, blocks).otherwise(F.array(_block("text", text=F.lit(EMPTY_MESSAGE))))


def _placed(messages: DataFrame, parts: DataFrame, anchored: bool, segment_rows: int | None, n: int) -> DataFrame:
    """Each message's place: turn, bucket, step and turn_steps, and what its events take from the messages around it.

    _first and _last are those of the turn, _turn_time is its first message's time, _user_time the time
    of the users that wait for the step and _waiting their number, _finish the turn's last. A session's events are ordered by turn, then bucket: the step's start, its users, its answer with calls and
    results, its end. _base is the number of events before the message's own but for a title; the turn's start is counted in.
    """
    keys = ["session_id", "msg_pos"]
    dealt = keys if segment_rows else keys[:1]
    kind, user = F.col("kind"), F.coalesce(F.col("role") == "user", F.lit(False))
    flags = scan.dealt(parts, n, *dealt).groupBy(*keys).agg(
        F.max(kind.isin(*T.STEP_KINDS)).alias("_opens"), F.max((kind.isin("reasoning", "text") & (F.col("text") != "")) | kind.isin("tool", "file")).alias("_kept"), F.count_if(kind == "tool").alias("_tools")
    )
    step = F.coalesce((F.col("role") == "assistant") & F.col("_opens"), F.lit(False))
    produced = step & F.coalesce("_kept", F.lit(False))
    own = user.cast("long") + F.when(step, 2).otherwise(0) + F.when(produced, 1 + 2 * F.col("_tools")).otherwise(0)
    rows = scan.dealt(messages, n, *dealt).join(flags, keys, "left")
    rows = rows.select(
        *keys, "role", *(["turn_id"] if anchored else []), "time", user.alias("_user"), step.alias("is_step"), produced.alias("_produced"), own.cast("long").alias("_own"), F.when(produced, F.col("finish")).alias("_finished")
    )
    rows = T.numbered_steps(T.anchored_turns(rows, segment_rows=segment_rows) if anchored else T.segment_turns(rows, segment_rows=segment_rows), segment_rows=segment_rows)
    user, time = F.col("_user"), F.when(F.col("_user"), F.col("time"))
    if segment_rows:
        turn = rows.groupBy("session_id", "turn").agg(
            F.min("msg_pos").alias("_from"), F.max("msg_pos").alias("_to"), F.min_by("time", "msg_pos").alias("_turn_time"), F.max_by("_finished", F.when(F.col("_finished").isNotNull(), F.col("msg_pos"))).alias("_finish"), F.sum("_own").alias("_all")
        )
        turn = scan.running(turn, ["session_id"], scan.segment_of("turn", segment_rows), "turn", sums={"_start": F.col("_all") + 2})
        waiting = rows.where(user).groupBy("session_id", "turn", "bucket").agg(F.min_by("time", F.when(F.col("time").isNotNull(), F.col("msg_pos"))).alias("_user_time"), F.count("*").alias("_waiting"))
        rows = scan.running(rows, ["session_id", "turn"], scan.segment_of("msg_pos", segment_rows), "msg_pos", sums={"_before": F.col("_own")})
        rows = rows.join(turn, ["session_id", "turn"]).join(waiting, ["session_id", "turn", "bucket"], "left")
        rows = rows.withColumns({"_first": F.col("msg_pos") == F.col("_from"), "_last": F.col("msg_pos") == F.col("_to"), "_base": F.col("_start") + 1 + F.col("_before"), "_waiting": F.coalesce("_waiting", F.lit(0).cast("long"))})
    else:
        # all of these windows have one sort: by turn, bucket and position
        turn = Window.partitionBy("session_id", "turn").orderBy("bucket", "msg_pos")
        bucket = Window.partitionBy("session_id", "turn", "bucket").orderBy("msg_pos")
        whole = lambda w: w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        rows = rows.withColumns(
            {
                "_first": F.row_number().over(turn) == 1,
                "_last": F.lead("msg_pos").over(turn).isNull(),
                "_turn_time": F.first("time").over(whole(turn)),
                "_finish": F.last("_finished", ignorenulls=True).over(whole(turn)),
                "_user_time": F.first(time, ignorenulls=True).over(whole(bucket)),
                "_waiting": F.sum(user.cast("long")).over(whole(bucket)),
            }
        )
        before = Window.partitionBy("session_id").orderBy("turn", "bucket", "msg_pos").rowsBetween(Window.unboundedPreceding, -1)
        brackets = F.col("_first").cast("long") + F.col("_last").cast("long")
        rows = rows.withColumn("_base", F.coalesce(F.sum(F.col("_own") + brackets).over(before), F.lit(0)) + F.col("_first").cast("long"))
    return rows.select(*keys, "turn", "bucket", "step", "turn_steps", "_produced", "_own", "_first", "_last", "_turn_time", "_user_time", "_finish", "_waiting", "_base")


def event_log(planned: DataFrame, sessions: DataFrame, format_version: int = 0, plugin: str = PLUGIN, segment_rows: int | None = None) -> DataFrame:
    """The log of every session: session_id, seq from 0, the event's fields and source_event_seqs.

    A session with a title that isn't blank begins with it. A tool's result
    refers to its call, the event before it. Sessions without messages have no
    turns. Events take their numbers from planned, in segments or not, so segment_rows changes nothing here.
    """
    user, step, base = F.col("role") == "user", F.col("is_step"), F.col("_base") + F.when(F.trim("session_title") != "", 1).otherwise(0)
    stub = lambda kind, seq, place=None: F.struct(F.lit(kind).alias("type"), seq.cast("long").alias("seq"), (F.lit(None) if place is None else place).cast("int").alias("place"))
    none = F.array().cast("array<struct<type:string,seq:bigint,place:int>>")
    some = lambda test, *stubs: F.when(test, F.array(*stubs)).otherwise(none)
    tools = F.filter(F.transform("parts", lambda p, i: F.when(p["kind"] == "tool", i)), lambda i: i.isNotNull())
    both = F.flatten(F.transform(tools, lambda place, i: F.array(stub("tool/call", base + 2 + 2 * i, place), stub("tool/result", base + 3 + 2 * i, place))))
    stubs = F.concat(
        some(F.col("_first"), stub("turn/start", base - 1)),
        some(step, stub("step/start", base - F.col("_waiting"))),
        # users stand behind the start of the step that they wait for
        some(user, stub("user/message", base + F.when(F.col("bucket") <= F.col("turn_steps"), 1).otherwise(0))),
        F.when(F.col("_produced"), F.concat(F.array(stub("assistant/message", base + 1)), both)).otherwise(none),
        some(step, stub("step/end", base + F.col("_own") - 1)),
        some(F.col("_last"), stub("turn/end", base + F.col("_own"))),
    )
    rows = planned.withColumn("_e", F.explode(stubs))
    part = lambda name: F.get("parts", F.col("_e.place"))[name]
    is_ = lambda *kinds: F.col("_e.type").isin(*kinds)
    said, answered, call, result, turn_end = (is_(k) for k in ("user/message", "assistant/message", "tool/call", "tool/result", "turn/end"))
    injected = F.col("origin").isNotNull() & (F.col("origin") != "real_user")
    message_time = F.coalesce("completed_time", "time")
    time = (
        F.when(is_("turn/start"), F.col("_turn_time"))
        .when(is_("step/start"), F.coalesce("_user_time", "time", "_turn_time"))
        .when(said, F.col("time"))
        .when(answered, message_time)
        .when(call, F.coalesce(part("time"), "time"))
        .when(result, F.coalesce(part("tool_end_time"), part("time"), "time"))
        .when(is_("step/end"), F.coalesce("completed_time", F.try_element_at("parts", F.lit(-1))["time"], "time"))
        .otherwise(F.coalesce("completed_time", "time", "_turn_time"))
    )
    surface = is_("user/message", "assistant/message", "tool/result")
    whose = F.when(said, F.when(injected, "injected").otherwise("user")).when(answered, "assistant").otherwise("tool-result")
    blocks = F.when(said, _user_blocks(F.col("parts"))).when(answered, _assistant_blocks(F.col("parts"))).when(result, F.array(_block("tool-result", id=part("call_id"), text=part("result"), is_error=part("is_error"))))
    kind, text, code = turn_end_reason(F.col("_finish"))
    # a user's event carries no turn of its own
    values = {
        "type": F.col("_e.type"),
        "time": F.greatest(F.lit(0).cast("long"), F.coalesce(time, F.lit(0)).cast("long")),
        "turn": F.when(~said, F.col("turn")),
        "step": F.when(is_("step/start", "assistant/message", "tool/call", "tool/result", "step/end"), F.col("step")),
        "surface_op": F.when(surface, "append"),
        "message_id": F.when(surface, I.message_id(F.col("session_id"), whose, F.when(result, part("id")).otherwise(F.col("id")))),
        "role": F.when(answered, "assistant").when(surface, "user"),
        "blocks": blocks,
        "source_kind": F.when(said, F.when(injected, "plugin").otherwise("user")).when(answered, "model").when(result, "tool"),
        "plugin": F.when(said & injected, plugin),
        "form": F.when(said & injected & (F.col("semantics_kind") == "compact_summary"), "recall"),
        "provider": F.when(answered, F.coalesce("provider", "session_provider", F.lit(plugin))),
        "model": F.when(answered, F.coalesce("model", "session_model", F.lit("unknown"))),
        "usage": F.when(answered, F.col("usage")),
        **({"stream": F.when(answered, _stream(_assistant_blocks(F.col("parts")), message_time))} if format_version >= 3 else {}),
        "call_id": F.when(call | result, part("call_id")),
        "name": F.when(call, part("tool_name")),
        "arguments": F.when(call, part("arguments")),
        "is_error": F.when(result, part("is_error")),
        "error_name": F.when(result & part("open"), OUTCOME_UNKNOWN[0]),
        "error_code": F.when(result & part("open"), OUTCOME_UNKNOWN[1]),
        "reason_kind": F.when(turn_end, kind),
        "reason_message": F.when(turn_end, text),
        "reason_code": F.when(turn_end, code),
    }
    fields = lambda made: [made.get(n, F.lit(None)).cast(t).alias(n) for n, t in FIELDS.items()]
    log = rows.select("session_id", F.col("_e.seq").alias("seq"), *fields(values))
    named = {"type": F.lit("session/title"), "time": F.greatest(F.lit(0).cast("long"), F.coalesce("created_at", F.lit(0))), "title": F.col("title"), "source_kind": F.lit("user")}
    titles = sessions.where(F.trim("title") != "").select("session_id", F.lit(0).cast("long").alias("seq"), *fields(named))
    return log.unionByName(titles).withColumn("source_event_seqs", F.when(F.col("type") == "tool/result", F.array(F.col("seq") - 1)))


def log_headers(sessions: DataFrame, format_version: int = 0, variant: str = "") -> DataFrame:
    """The header of each session's log."""
    return sessions.select(
        "session_id",
        I.target_session_id(F.col("session_id"), variant).alias("target_id"),
        F.lit(format_version).alias("version"),
        F.greatest(F.lit(0).cast("long"), "created_at").alias("created_at"),
        F.nullif(F.col("directory"), F.lit("")).alias("cwd"),
        F.lit(0).alias("delegation_depth"),
        *([F.lit(False).alias("is_seeded")] if format_version >= 3 else []),
    )


def plan_stats(planned: DataFrame, events: DataFrame) -> DataFrame:
    """Counters of each session's plan, one row a session.

    user_side_lost is ours: reasoning and tool parts inside user messages, which
    a log has no place for.
    """
    p, user, step = F.col("parts"), F.col("role") == "user", F.col("is_step")
    n = lambda test: F.size(F.filter(p, test))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    emitted = user | step
    known = ("text", "reasoning", "tool", "file", "step-start", "step-finish", "timeline", "compaction")
    blocks = n(lambda x: (x["kind"].isin("reasoning", "text") & (x["text"] != "")) | x["kind"].isin("tool", "file"))
    content = n(lambda x: ((x["kind"] == "text") & (x["text"] != "")) | (x["kind"] == "file"))
    chars = F.aggregate(F.filter(p, lambda x: x["kind"] == "reasoning"), F.lit(0).cast("long"), lambda a, x: a + I.utf16_length(x["text"]))
    tools = lambda test: total(F.when(step, n(lambda x: (x["kind"] == "tool") & test(x))))
    injected = F.col("origin").isNotNull() & (F.col("origin") != "real_user")
    counters = {
        # turns are numbered from 1 without gaps
        "turns": F.coalesce(F.max("turn"), F.lit(0)).cast("long"),
        "steps": F.count_if(step),
        "empty_steps": F.count_if(step & (blocks == 0)),
        "user_messages": F.count_if(user),
        "injected_messages": F.count_if(user & injected),
        "assistant_messages": F.count_if(step & (blocks > 0)),
        "reasoning_blocks": total(F.when(step, n(lambda x: (x["kind"] == "reasoning") & (x["text"] != "")))),
        "reasoning_chars": total(F.when(step, chars)),
        "empty_reasoning": total(F.when(step, n(lambda x: (x["kind"] == "reasoning") & (x["text"] == "")))),
        "text_blocks": total(F.when(emitted, content)),
        "empty_text_skipped": total(F.when(emitted, n(lambda x: (x["kind"] == "text") & (x["text"] == "")))),
        "tool_calls": tools(lambda x: F.lit(True)),
        "tool_errors": tools(lambda x: x["status"] == "error"),
        "tool_results_synthesized": tools(lambda x: x["open"]),
        "empty_outputs": tools(lambda x: ~x["is_error"] & (x["result"] == EMPTY_OUTPUT)),
        **{f"arguments_{h}": tools(lambda x, h=h: x["how"] == h) for h in ("verbatim", "wrapped", "absent", "reserialized")},
        "files": total(F.when(emitted, n(lambda x: x["kind"] == "file"))),
        "file_placeholders": total(F.when(emitted, n(lambda x: x["kind"] == "file"))),
        "markers_skipped": total(F.when(emitted, n(lambda x: x["kind"].isin("timeline", "compaction"))) + F.when(user, n(lambda x: ~x["kind"].isin(*known, "unknown"))).otherwise(0)),
        "unknown_parts": total(F.when(user, n(lambda x: x["kind"] == "unknown")).when(step, n(lambda x: ~x["kind"].isin(*known)))),
        "non_content_messages": F.count_if((F.col("role") == "assistant") & ~step),
        "placeholder_messages": F.count_if(user & (content == 0)),
        "user_side_lost": total(F.when(user, n(lambda x: x["kind"].isin("reasoning", "tool")))),
    }
    rows = planned.groupBy("session_id").agg(*(c.alias(k) for k, c in counters.items()))
    # counted for itself, as one task would hold the sorts of plan and log at once
    return rows.join(cut(events.groupBy("session_id").agg(F.count("*").alias("events"))), "session_id", "left").withColumn("events", F.coalesce("events", F.lit(0).cast("long")))
