"""Legacy JSONL sessions: one record a line, content as blocks, under projects/."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import json as J
from ..operators.turns import segment_turns
from ..operators.warnings import rows_of
from . import lines
from .rollout import tool_parts

FILES, DEPTH, TITLE = "*.jsonl", 4, 80


def _within(df: DataFrame, root: str) -> DataFrame:
    """Files at most DEPTH folders below root."""
    below = F.element_at(F.split("path", f"/{root.rstrip('/').rsplit('/', 1)[-1]}/"), -1)
    return df.where(F.size(F.split(below, "/")) <= DEPTH + 1)


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """One row a file, latest first; the id is legacy: and the path."""
    files = _within(lines.listing(spark, root, FILES, recursive=True), root)
    stem = F.regexp_extract("path", r"([^/]*)\.jsonl$", 1)
    return files.select(F.concat(F.lit("legacy:"), "path").alias("session_id"), stem.alias("title"), F.lit("").alias("directory"), F.col("modified").alias("created_at"), F.col("modified").alias("updated_at"), F.lit("legacy").alias("source_kind"), "bytes", F.lit(True).alias("partial"))


def _first_line(text):
    return F.substring(F.substring_index(text, "\n", 1), 1, TITLE)


def read(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(sessions, messages, parts, warnings) of all legacy files under root.

    Sidechain records and user records that hold only tool results are no
    messages. Turns begin with 1: a user message after an assistant's opens the next.
    """
    raw = _within(lines.records(spark, root, FILES, recursive=True), root)
    rows = lines.numbered(raw).select(F.concat(F.lit("legacy:"), "path").alias("session_id"), "record", J.parsed(F.col("data")).alias("v"))
    v = F.col("v")
    order = Window.partitionBy("session_id").orderBy("record")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stamp = F.nullif(J.iso_millis(J.string(J.at(v, "$.timestamp"))), F.lit(0).cast("long"))
    type_ = J.pick_text(v, "$.type")
    rows = rows.select(
        "session_id", "record", type_.alias("type"), F.coalesce(F.last(stamp, ignorenulls=True).over(so_far), F.lit(0).cast("long")).alias("time"), J.string(J.at(v, "$.cwd")).alias("cwd"), J.pick_text(v, "$.summary").alias("summary"),
        F.coalesce(F.try_variant_get(v, "$.isSidechain", "boolean"), F.lit(False)).alias("side"), F.coalesce(F.try_variant_get(v, "$.isMeta", "boolean"), F.lit(False)).alias("meta"),
        F.coalesce(J.pick_text(v, "$.message.role"), F.when(type_.isin("user", "assistant"), type_)).alias("role"), J.pick_text(v, "$.uuid").alias("uuid"),
        F.coalesce(J.pick_text(v, "$.message.model"), J.pick_text(v, "$.model")).alias("model"), J.pick_text(v, "$.provider").alias("provider"), F.try_variant_get(v, "$.message.content", "variant").alias("content"),
    )
    spoken = rows.where("type is distinct from 'summary' and not side and role in ('user', 'assistant')")
    whole = J.string(F.col("content"))
    blocks = F.coalesce(F.try_variant_get("content", "$", "array<variant>"), F.array().cast("array<variant>"))
    block_type = lambda b: J.string(J.at(b, "$.type"))
    tag = lambda i: F.concat(F.lit("legacy-"), F.col("record").cast("string"), F.lit("-b"), i.cast("string"))

    def piece(b, i):
        kind = F.when(block_type(b) == "text", "text").when(block_type(b).isin("thinking", "reasoning"), "reasoning").when(block_type(b) == "tool_use", "tool")
        text = F.when(kind == "text", J.pick_text(b, "$.text")).when(kind == "reasoning", J.pick_text(b, "$.thinking", "$.text", "$.reasoning", "$.value"))
        input_ = F.try_variant_get(b, "$.input", "variant")
        given = ~F.is_variant_null(input_)
        tool = kind == "tool"
        return F.struct(
            kind.alias("kind"), i.alias("o"), tag(i).alias("id"), text.alias("text"),
            F.when(tool, F.coalesce(J.pick_text(b, "$.id", "$.tool_use_id", "$.toolUseId"), F.concat(F.lit("legacy-call-"), F.col("record").cast("string"), F.lit("-"), i.cast("string")))).alias("call_id"),
            F.when(tool, F.coalesce(J.pick_text(b, "$.name", "$.tool"), F.lit("unknown-tool"))).alias("tool_name"),
            F.when(tool & given, F.when(J.kind(input_) == "STRING", F.try_variant_get(input_, "$", "string")).otherwise(input_.cast("string"))).alias("input"), F.when(tool & given, J.kind(input_)).alias("input_kind"),
        )

    pieces = F.filter(F.transform(blocks, piece), lambda p: p["kind"].isNotNull() & ((p["kind"] == "tool") | p["text"].isNotNull()))
    single = F.array(F.struct(F.lit("text").alias("kind"), F.lit(0).alias("o"), F.concat(F.lit("legacy-"), F.col("record").cast("string"), F.lit("-t")).alias("id"), whole.alias("text"), *(F.lit(None).cast("string").alias(n) for n in ("call_id", "tool_name", "input", "input_kind"))))
    spoken = spoken.withColumn("pieces", F.when(whole != "", single).when(whole == "", F.filter(single, lambda p: F.lit(False))).otherwise(pieces)).withColumn("has_result", F.exists(blocks, lambda b: F.coalesce(block_type(b) == "tool_result", F.lit(False))))
    results = spoken.select("session_id", "record", "time", F.posexplode(F.filter(F.transform(blocks, lambda b, i: F.struct(i.alias("o"), b.alias("b"))), lambda x: F.coalesce(block_type(x["b"]) == "tool_result", F.lit(False)))).alias("_n", "x"))
    inner = F.coalesce(F.try_variant_get("x.b", "$.content", "array<variant>"), F.array().cast("array<variant>"))
    answers = results.select(
        "session_id", (F.col("record") * 1000 + F.col("x.o") + 1).alias("pos"), J.pick_text(F.col("x.b"), "$.tool_use_id", "$.toolUseId", "$.id").alias("call_id"),
        F.coalesce(J.string(J.at(F.col("x.b"), "$.content")), F.array_join(F.transform(inner, lambda c: F.coalesce(J.string(J.at(c, "$.text")), F.lit(""))), "")).alias("text"),
        F.coalesce(F.try_variant_get("x.b", "$.is_error", "boolean"), F.lit(False)).alias("is_error"), "time",
    )
    talk = spoken.where(~((F.col("role") == "user") & F.col("has_result") & (F.size("pieces") == 0)))
    turned = segment_turns(talk, position="record").where(F.size("pieces") > 0).withColumn("msg_pos", F.row_number().over(order).cast("long") - 1)
    null = lambda n: F.lit(None).cast("string").alias(n)
    messages = turned.select(
        "session_id", "msg_pos", F.coalesce("uuid", F.concat(F.lit("legacy-"), F.col("record").cast("string"))).alias("id"), "role", "time", F.col("time").alias("completed_time"), F.concat(F.lit("legacy-turn-"), F.col("turn").cast("string")).alias("turn_id"),
        F.when(F.col("role") == "user", F.when(F.col("meta"), "legacy_meta").otherwise("real_user")).alias("origin"), null("semantics_kind"), null("visibility"), "model", "provider", null("mode"), null("agent"), null("finish"),
        F.lit(None).cast("struct<cache_read:bigint,cache_write:bigint,input:bigint,output:bigint,reasoning:bigint>").alias("usage"), null("cwd"), null("summary_title"), null("summary_body"), F.lit(True).alias("json_ok"),
    )
    flat = turned.select("session_id", "msg_pos", F.col("record").alias("idx"), "time", F.posexplode("pieces").alias("part_pos", "p"))
    parts = tool_parts(flat, answers)
    spoke = turned.where(F.col("role") == "user").withColumn("_head", F.get("pieces", F.lit(0))).where("_head.kind = 'text'")
    first_said = spoke.groupBy("session_id").agg(_first_line(F.min_by("_head.text", "record")).alias("_said"))
    about = rows.groupBy("session_id").agg(
        F.min_by("time", F.when(F.col("time") > 0, F.col("record"))).alias("created_at"), F.max("time").alias("updated_at"), F.min_by("cwd", F.when(F.col("cwd").isNotNull() & (F.col("cwd") != ""), F.col("record"))).alias("directory"),
        _first_line(F.min_by("summary", F.when((F.col("type") == "summary") & F.col("summary").isNotNull(), F.col("record")))).alias("_summary"), F.count("*").alias("records"),
    )
    talking = turned.select("session_id").distinct()
    known = about.join(first_said, "session_id", "left")
    sessions = known.join(talking, "session_id", "left_semi").select(
        "session_id", F.coalesce("_summary", "_said", F.lit("")).alias("title"), F.coalesce("directory", F.lit("")).alias("directory"), F.coalesce("created_at", F.lit(0).cast("long")).alias("created_at"), "updated_at", F.lit("legacy").alias("source_kind"),
        null("project_id"), F.lit("legacy").alias("source_version"), null("task_type"), null("model"), null("provider"),
    )
    warned = (
        rows_of(sessions, "legacy-best-effort")
        .unionByName(rows_of(about.join(talking, "session_id", "left_anti"), "legacy-no-messages", "error"))
        .unionByName(rows_of(lines.malformed(raw).withColumn("session_id", F.concat(F.lit("legacy:"), "path")), "legacy-malformed-lines", "warning", F.create_map(F.lit("count"), F.col("malformed").cast("string"))))
    )
    return sessions, messages, parts, warned
