"""Request-window transcripts: one JSON line a model call, with the window of messages it was sent.

Windows overlap. They are merged by each message's global index, where the
earliest window that holds it wins; the last call's response is added, as no
window repeats it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import json as J
from ..operators.turns import segment_turns
from ..operators.warnings import rows_of
from . import lines

FILES = "model-io-*.jsonl"
#: Calls whose messages are searched for the working folder, and how they name it.
FIRST_CALLS, CWD = 8, r'"cwd"\s*:\s*"((?:[^"\\]|\\.)*)"'
_CALL = "array<struct<id:string,name:string,input:variant>>"


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """One row a transcript: the id is in the file's name, the times are the file's."""
    files = lines.listing(spark, root, FILES)
    name = F.regexp_extract("path", r"model-io-(.*)\.jsonl$", 1)
    return files.select(F.url_decode(name).alias("session_id"), F.lit("").alias("title"), F.lit("").alias("directory"), F.col("modified").alias("created_at"), F.col("modified").alias("updated_at"), F.lit("rollout").alias("source_kind"), "bytes", F.lit(True).alias("partial"))


def merged_windows(windows: DataFrame, session: str = "session_id") -> DataFrame:
    """windows(session, record, idx, pos, size, ...) with one row an index: the earliest record's, with terminal.

    terminal tells that the message is the last of some window that holds it.
    """
    by_index = Window.partitionBy(session, "idx")
    rows = windows.withColumn("terminal", F.max(F.col("pos") == F.col("size") - 1).over(by_index))
    return rows.withColumn("_nth", F.row_number().over(by_index.orderBy("record", "pos"))).where("_nth = 1").drop("_nth")


def window_gaps(requests: DataFrame, session: str = "session_id") -> DataFrame:
    """(session, gap): whether a window begins after the end of the one before. requests(session, record, offset, size)."""
    order = Window.partitionBy(session).orderBy("record")
    end = F.lag(F.col("offset") + F.col("size")).over(order)
    return requests.withColumn("_gap", F.coalesce(end < F.col("offset"), F.lit(False))).groupBy(session).agg(F.bool_or("_gap").alias("gap"))


def directories(windows: DataFrame) -> DataFrame:
    """(session_id, directory): the working folder that the messages of the first calls name first, its JSON escapes undone."""
    content = F.try_variant_get("m", "$.content", "variant")
    texts = windows.where(F.col("record") < FIRST_CALLS).select("session_id", "record", "pos", F.coalesce(J.string(content), content.cast("string")).alias("text"))
    first = texts.where(F.col("text").rlike(CWD)).groupBy("session_id").agg(F.min_by(F.regexp_extract("text", CWD, 1), F.struct("record", "pos")).alias("named"))
    plain = J.string(J.parsed(F.concat(F.lit('"'), "named", F.lit('"'))))
    return first.select("session_id", F.coalesce(plain, "named").alias("directory"))


def _parts(df: DataFrame, prefix, calls) -> DataFrame:
    """Message rows (session_id, at, time, reasoning, text, calls) as parts in order."""
    none = F.array().cast("array<struct<kind:string,o:int,id:string,text:string,call_id:string,tool_name:string,input:string,input_kind:string>>")
    said = lambda kind, column, tag, order: F.when(
        F.col(column) != "", F.array(F.struct(F.lit(kind).alias("kind"), F.lit(order).alias("o"), F.concat(prefix, F.lit(tag)).alias("id"), F.col(column).alias("text"), *_nothing()))
    ).otherwise(none)
    tools = F.transform(
        F.coalesce(calls, F.array().cast(_CALL)),
        lambda c, i: F.struct(
            F.lit("tool").alias("kind"),
            (i + 2).alias("o"),
            F.concat(prefix, F.lit("-c"), i.cast("string")).alias("id"),
            F.lit(None).cast("string").alias("text"),
            F.coalesce(c["id"], F.concat(F.lit("call-"), prefix, F.lit("-"), i.cast("string"))).alias("call_id"),
            F.coalesce(c["name"], F.lit("unknown-tool")).alias("tool_name"),
            F.when(J.kind(c["input"]) == "STRING", F.try_variant_get(c["input"], "$", "string")).otherwise(F.when(~F.is_variant_null(c["input"]), c["input"].cast("string"))).alias("input"),
            F.when(~F.is_variant_null(c["input"]), J.kind(c["input"])).alias("input_kind"),
        ),
    )
    return df.withColumn("pieces", F.concat(said("reasoning", "reasoning", "-r", 0), said("text", "text", "-t", 1), tools))


def _nothing() -> list:
    return [F.lit(None).cast("string").alias(n) for n in ("call_id", "tool_name", "input", "input_kind")]


def _content(message, field: str):
    """(reasoning, text) of a message's content: a string, or blocks joined."""
    v = F.try_variant_get(message, field, "variant")
    blocks = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array().cast("array<variant>"))
    joined = lambda test: F.array_join(F.transform(F.filter(blocks, test), lambda b: F.coalesce(J.string(J.at(b, "$.text")), F.lit(""))), "")
    is_reasoning = lambda b: F.coalesce(J.string(J.at(b, "$.type")) == "reasoning", F.lit(False))
    text = J.string(v)
    return F.when(text.isNotNull(), "").otherwise(joined(is_reasoning)), F.coalesce(text, joined(lambda b: ~is_reasoning(b)))


def read(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(sessions, messages, parts, warnings) of all transcripts under root."""
    raw = lines.records(spark, root, FILES)
    name = F.url_decode(F.regexp_extract("path", r"model-io-(.*)\.jsonl$", 1))
    rows = lines.numbered(raw).withColumn("session_id", name).withColumn("v", J.parsed(F.col("data")))
    v = F.col("v")
    time = lambda p: J.iso_millis(J.string(J.at(v, p)))
    started = time("$.startedAt")
    rows = rows.select(
        "session_id",
        "record",
        started.alias("started"),
        F.when(time("$.completedAt") > 0, time("$.completedAt")).otherwise(started).alias("completed"),
        J.pick_string(v, "$.model.modelId").alias("model"),
        J.pick_string(v, "$.model.providerId").alias("provider"),
        F.coalesce(J.whole(J.at(v, "$.request.messageOffset")), F.lit(0)).alias("offset"),
        F.coalesce(F.try_variant_get(v, "$.request.messages", "array<variant>"), F.array().cast("array<variant>")).alias("messages"),
        F.try_variant_get(v, "$.response", "variant").alias("response"),
    ).withColumn("size", F.size("messages"))

    windows = rows.select("session_id", "record", "started", "offset", "size", F.posexplode("messages").alias("pos", "m")).withColumn("idx", F.col("offset") + F.col("pos"))
    merged = merged_windows(windows)
    role = J.string(J.at(F.col("m"), "$.role"))
    order = Window.partitionBy("session_id").orderBy("idx")
    carried = F.coalesce(F.last(F.nullif(F.col("started"), F.lit(0).cast("long")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0).cast("long"))
    reasoning, text = _content(F.col("m"), "$.content")
    entries = segment_turns(merged.withColumn("role", role), position="idx").select(
        "session_id", "idx", "role", "turn", "terminal", carried.alias("time"), reasoning.alias("reasoning"), text.alias("text"),
        F.try_variant_get("m", "$.toolCalls", _CALL).alias("calls"), "m",
        F.lit(None).cast("string").alias("finish"), F.lit(None).cast("struct<cache_read:bigint,cache_write:bigint,input:bigint,output:bigint,reasoning:bigint>").alias("usage"), F.lit(False).alias("final"),
    )
    last = Window.partitionBy("session_id").orderBy(F.desc("record"))
    top = entries.groupBy("session_id").agg(F.max("idx").alias("_idx"), F.max("turn").alias("_turn"))
    r = F.col("response")
    final = rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").join(top, "session_id", "left").select(
        "session_id", (F.coalesce("_idx", F.lit(-1)) + 1).alias("idx"), F.lit("assistant").alias("role"), F.coalesce("_turn", F.lit(1)).alias("turn"), F.lit(False).alias("terminal"), F.col("completed").alias("time"),
        F.coalesce(J.string(J.at(r, "$.reasoningText")), F.lit("")).alias("reasoning"), F.coalesce(J.string(J.at(r, "$.text")), F.lit("")).alias("text"), F.try_variant_get(r, "$.toolCalls", _CALL).alias("calls"), r.alias("m"),
        J.pick_string(r, "$.finishReason").alias("finish"), J.usage(J.at(r, "$.usage")).alias("usage"), F.lit(True).alias("final"),
    )
    about = rows.groupBy("session_id").agg(
        F.min_by("started", "record").alias("first_at"), F.max("completed").alias("last_at"), F.max_by("model", F.when(F.col("model").isNotNull(), F.col("record"))).alias("model"), F.max_by("provider", F.when(F.col("provider").isNotNull(), F.col("record"))).alias("provider"),
        F.count("*").alias("lines"),
    ).join(directories(windows), "session_id", "left")
    prefix = F.when(F.col("final"), "rollout-final").otherwise(F.concat(F.lit("rollout-window-"), F.col("idx").cast("string")))
    spoken = _parts(entries.unionByName(final).where("role in ('user', 'assistant')"), prefix, F.when(F.col("role") == "assistant", F.col("calls")))
    kept = spoken.where("(role = 'user' and text <> '') or (role = 'assistant' and size(pieces) > 0)")
    position = Window.partitionBy("session_id").orderBy("idx")
    kept = kept.withColumn("msg_pos", F.row_number().over(position).cast("long") - 1).join(about.select("session_id", "model", "provider"), "session_id").withColumn("id", prefix)
    null = lambda n: F.lit(None).cast("string").alias(n)
    user = F.col("role") == "user"
    messages = kept.select(
        "session_id", "msg_pos", "id", "role", "time", F.col("time").alias("completed_time"), F.concat(F.lit("rollout-turn-"), F.col("turn").cast("string")).alias("turn_id"),
        F.when(user, F.when(F.col("terminal"), "real_user").otherwise("rollout_undetermined")).alias("origin"), F.when(user, "user_prompt").alias("semantics_kind"), null("visibility"),
        F.when(~user, F.col("model")).alias("model"), F.when(~user, F.col("provider")).alias("provider"), null("mode"), null("agent"), "finish", "usage", null("cwd"), null("summary_title"), null("summary_body"), F.lit(True).alias("json_ok"),
    )
    pieces = kept.select("session_id", "msg_pos", "idx", "time", F.posexplode(F.when(user, F.filter("pieces", lambda p: p["kind"] == "text")).otherwise(F.col("pieces"))).alias("part_pos", "p"))
    answers = entries.where("role = 'tool'").select(
        "session_id", (F.col("idx") * 1000).alias("pos"), J.pick_text(F.col("m"), "$.toolCallId", "$.tool_call_id", "$.id").alias("call_id"),
        F.coalesce(J.string(J.at(F.col("m"), "$.content")), F.lit("")).alias("text"), F.coalesce(F.try_variant_get("m", "$.isError", "boolean"), F.lit(False)).alias("is_error"), "time",
    )
    parts = tool_parts(pieces, answers)
    warned = warnings(about, window_gaps(rows), lines.malformed(raw).select(F.url_decode(F.regexp_extract("path", r"model-io-(.*)\.jsonl$", 1)).alias("session_id"), "malformed"))
    # calls that leave no message to import
    warned = warned.unionByName(rows_of(about.join(kept.select("session_id").distinct(), "session_id", "left_anti"), "rollout-empty", "error"))
    earliest = lambda a, b: F.coalesce(F.nullif(F.col(a), F.lit(0).cast("long")), F.col(b))
    sessions = about.select(
        "session_id", F.lit("").alias("title"), F.coalesce("directory", F.lit("")).alias("directory"), earliest("first_at", "last_at").alias("created_at"), earliest("last_at", "first_at").alias("updated_at"), F.lit("rollout").alias("source_kind"),
        null("project_id"), null("source_version"), null("task_type"), "model", "provider",
    )
    return sessions, messages, parts, warned


def tool_parts(pieces: DataFrame, answers: DataFrame) -> DataFrame:
    """pieces(session_id, msg_pos, idx, time, part_pos, p) as parts; tools take their answers' outcome."""
    flat = pieces.select("session_id", "msg_pos", F.col("part_pos").cast("long").alias("part_pos"), (F.col("idx") * 1000 + F.col("part_pos") + 1).alias("pos"), "time", "p.*").drop("o")
    done = lines.late_results(flat.where("kind = 'tool'"), answers)
    rest = flat.where("kind <> 'tool'").withColumns({"result_text": F.lit(None).cast("string"), "result_error": F.lit(None).cast("boolean"), "result_time": F.lit(None).cast("long")})
    tool, answered = F.col("kind") == "tool", F.col("result_error").isNotNull()
    null = lambda n, t="string": F.lit(None).cast(t).alias(n)
    return done.unionByName(rest).select(
        "session_id", "msg_pos", "part_pos", "id", "kind", "time", "text", "call_id", "tool_name",
        F.when(tool, F.when(~answered, "running").when(F.col("result_error"), "error").otherwise("completed")).alias("status"), "input", "input_kind",
        F.when(~F.col("result_error"), F.col("result_text")).alias("output"), F.when(F.col("result_error"), F.col("result_text")).alias("error"), F.col("result_time").alias("tool_end_time"),
        null("mime"), null("url"), null("size_bytes", "long"), null("step_finish_reason"), F.lit(True).alias("json_ok"),
    )


def warnings(about: DataFrame, gaps: DataFrame, malformed: DataFrame) -> DataFrame:
    """The reader's warnings as rows."""
    return (
        rows_of(about, "rollout-fallback", "warning", F.create_map(F.lit("lines"), F.col("lines").cast("string")))
        .unionByName(rows_of(gaps.where("gap"), "rollout-window-gap", "warning"))
        .unionByName(rows_of(malformed, "rollout-malformed-lines", "warning", F.create_map(F.lit("count"), F.col("malformed").cast("string"))))
    )
