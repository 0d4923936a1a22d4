"""From stored records with JSON payloads to messages and parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import json as J


def with_optional(df: DataFrame, *columns: tuple[str, str]) -> DataFrame:
    """df with missing (name, type) columns added as NULL: stores differ in their columns."""
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in columns if name not in df.columns}) if columns else df


def _number(column: str) -> Column:
    return F.coalesce(F.col(column).try_cast("bigint"), F.lit(0).cast("bigint"))


def message_rows(message: DataFrame) -> DataFrame:
    """Stored messages plus msg_pos, from 0, by (sequence, time_created, id) within the session."""
    rows = with_optional(message, ("sequence", "bigint"), ("time_created", "bigint"))
    order = Window.partitionBy("session_id").orderBy(_number("sequence"), _number("time_created"), "id")
    return rows.withColumn("msg_pos", F.row_number().over(order).cast("long") - 1)


def part_rows(part: DataFrame) -> DataFrame:
    """Stored parts plus part_pos, from 0, by (sequence, time_created, id) within the message."""
    rows = with_optional(part, ("sequence", "bigint"), ("time_created", "bigint"))
    order = Window.partitionBy("session_id", "message_id").orderBy(_number("sequence"), _number("time_created"), "id")
    return rows.withColumn("part_pos", F.row_number().over(order).cast("long") - 1)


def normalized_sessions(session: DataFrame) -> DataFrame:
    """One row per session; the directory falls back to the path, missing texts to ''."""
    rows = with_optional(session, *((c, "string") for c in ("title", "directory", "path", "project_id", "version", "task_type")), ("time_created", "bigint"), ("time_updated", "bigint"))
    return rows.select(
        F.col("id").alias("session_id"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce(F.nullif(F.col("directory"), F.lit("")), F.col("path"), F.lit("")).alias("directory"),
        _number("time_created").alias("created_at"),
        _number("time_updated").alias("updated_at"),
        F.lit("sqlite").alias("source_kind"),
        "project_id",
        F.col("version").alias("source_version"),
        "task_type",
    )


def normalized_messages(message: DataFrame) -> DataFrame:
    """Messages with the fields of their JSON, by fallback chains; json_ok tells whether it could be read.

    completed_time is read from time.start, else time.created, as the stored
    logs have it.
    """
    rows = message_rows(message).withColumn("_v", J.parsed(F.col("data")))
    v = F.col("_v")
    return rows.select(
        "session_id",
        "msg_pos",
        F.col("id"),
        F.when(J.pick_string(v, "$.role") == "assistant", "assistant").otherwise("user").alias("role"),
        _number("time_created").alias("time"),
        J.pick_time(J.at(v, "$.time")).alias("completed_time"),
        F.coalesce(J.pick_string(v, "$.anchor.turnId", "$.anchor.turnID", "$.anchor.turn"), J.pick_string(v, "$.turnId")).alias("turn_id"),
        J.pick_string(v, "$.semantics.origin").alias("origin"),
        J.pick_string(v, "$.semantics.kind").alias("semantics_kind"),
        J.pick_string(v, "$.semantics.uiVisibility").alias("visibility"),
        F.coalesce(J.pick_string(v, "$.modelID"), J.pick_string(v, "$.model.modelID", "$.model.id")).alias("model"),
        F.coalesce(J.pick_string(v, "$.providerID"), J.pick_string(v, "$.model.providerID", "$.model.provider")).alias("provider"),
        J.pick_string(v, "$.mode").alias("mode"),
        J.pick_string(v, "$.agent").alias("agent"),
        J.pick_string(v, "$.finish").alias("finish"),
        J.usage(J.pick(v, "$.tokens", "$.usage")).alias("usage"),
        F.coalesce(J.pick_string(v, "$.path.cwd"), J.pick_string(v, "$.contextSnapshot.envInfo.cwd")).alias("cwd"),
        J.pick_string(v, "$.summary.title").alias("summary_title"),
        J.pick_string(v, "$.summary.body").alias("summary_body"),
        (J.kind(v) == "OBJECT").alias("json_ok"),
    )


def normalized_parts(part: DataFrame, messages: DataFrame) -> DataFrame:
    """Parts keyed by session, msg_pos and part_pos, with the fields of their kind.

    Other names of a kind become one (thinking, tool-call, tool_call,
    attachment); an unknown type is kept as its kind, a missing one is unknown.
    input is JSON text, input_kind its kind. A part without a time has its message's.
    """
    rows = part_rows(part).withColumn("_v", J.parsed(F.col("data")))
    owner = messages.select("session_id", F.col("id").alias("message_id"), "msg_pos", F.col("time").alias("_message_time"))
    rows = rows.join(owner, ["session_id", "message_id"])
    v = F.col("_v")
    type_ = F.coalesce(J.string(J.at(v, "$.type")), F.lit("unknown"))
    kind = (
        F.when(type_.isin("reasoning", "thinking"), "reasoning")
        .when(type_.isin("tool", "tool-call", "tool_call"), "tool")
        .when(type_.isin("file", "attachment"), "file")
        .otherwise(type_)
    )
    rows = rows.withColumn("_kind", kind)
    is_ = lambda k: F.col("_kind") == k
    tool = lambda c: F.when(is_("tool"), c)
    input_ = J.pick(v, "$.state.input", "$.state.args", "$.input", "$.args")
    # get_json_object keeps the order of an object's keys, which a variant doesn't
    text_of = lambda path: F.when(J.at(v, path).isNotNull(), F.get_json_object("data", path))
    meta = J.pick(v, "$.metadata", "$.meta")
    return rows.select(
        "session_id",
        "msg_pos",
        "part_pos",
        "id",
        F.col("_kind").alias("kind"),
        F.coalesce(F.nullif(_number("time_created"), F.lit(0).cast("bigint")), F.col("_message_time"), F.lit(0).cast("bigint")).alias("time"),
        F.when(is_("text"), F.coalesce(J.pick_string(v, "$.text"), F.lit("")))
        .when(is_("reasoning"), F.coalesce(J.pick_string(v, "$.text", "$.thinking", "$.reasoning", "$.value"), F.lit("")))
        .alias("text"),
        tool(J.pick_string(v, "$.callID", "$.callId", "$.toolCallId", "$.id")).alias("call_id"),
        tool(F.coalesce(J.pick_string(v, "$.tool", "$.name", "$.toolName"), F.lit("unknown-tool"))).alias("tool_name"),
        tool(F.coalesce(J.pick_string(v, "$.state.status"), F.lit("completed"))).alias("status"),
        tool(F.coalesce(*(text_of(p) for p in ("$.state.input", "$.state.args", "$.input", "$.args")))).alias("input"),
        tool(J.kind(input_)).alias("input_kind"),
        tool(F.coalesce(J.pick_string(v, "$.state.output"), J.pick_string(v, "$.output"))).alias("output"),
        tool(F.coalesce(J.pick_string(v, "$.state.error"), J.pick_string(v, "$.error"))).alias("error"),
        tool(J.pick_time(J.at(v, "$.state.time"))).alias("tool_end_time"),
        F.when(is_("file"), J.pick_string(v, "$.mime", "$.mimeType", "$.mediaType")).alias("mime"),
        F.when(is_("file"), J.pick_string(v, "$.url", "$.uri")).alias("url"),
        F.when(is_("file"), J.whole(J.at(meta, "$.sizeBytes"))).alias("size_bytes"),
        F.when(is_("step-finish"), J.pick_string(v, "$.reason", "$.finishReason")).alias("step_finish_reason"),
        (J.kind(v) == "OBJECT").alias("json_ok"),
    )


def with_session_model(sessions: DataFrame, messages: DataFrame) -> DataFrame:
    """sessions plus model and provider: those of the first message that has either."""
    first = messages.where("model is not null or provider is not null").groupBy("session_id").agg(F.min_by(F.struct("model", "provider"), "msg_pos").alias("_m"))
    return sessions.join(first, "session_id", "left").withColumn("model", F.col("_m.model")).withColumn("provider", F.col("_m.provider")).drop("_m")


def inventory(session: DataFrame, message: DataFrame, part: DataFrame) -> DataFrame:
    """Sessions with their numbers of messages, reasoning and tool parts, latest first."""
    of_type = F.get_json_object("data", "$.type")
    messages = message.groupBy("session_id").agg(F.count("*").alias("message_count"))
    parts = part.groupBy("session_id").agg(F.count_if(of_type.isin("reasoning", "thinking")).alias("reasoning_count"), F.count_if(of_type.isin("tool", "tool-call")).alias("tool_count"))
    counts = ("message_count", "reasoning_count", "tool_count")
    rows = normalized_sessions(session).join(messages, "session_id", "left").join(parts, "session_id", "left")
    return rows.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in counts}).orderBy(F.desc("updated_at"), "session_id")
