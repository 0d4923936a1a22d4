"""Warnings as rows: (session_id, code, severity, where, detail)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NONE = "map<string,string>"


def rows_of(df: DataFrame, code: str, severity: str = "warning", detail: Column | None = None, where: Column | None = None, session: str = "session_id") -> DataFrame:
    """One warning for each row of df."""
    return df.select(
        F.col(session).alias("session_id"),
        F.lit(code).alias("code"),
        F.lit(severity).alias("severity"),
        (where if where is not None else F.lit(None)).cast("string").alias("where"),
        (detail if detail is not None else F.lit(None)).cast(_NONE).alias("detail"),
    )


def degradations(stats: DataFrame) -> DataFrame:
    """One warning a session for each counter of lost or stood-in content that isn't 0."""
    counters = (("attachment-placeholder", "info", "file_placeholders"), ("tool-result-synthesized", "warning", "tool_results_synthesized"), ("tool-output-empty", "info", "empty_outputs"), ("tool-arguments-not-json", "warning", "arguments_wrapped"), ("unknown-part-type", "warning", "unknown_parts"), ("empty-user-message", "info", "placeholder_messages"))
    entries = F.array(*(F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), F.col(c).alias("n")) for code, severity, c in counters))
    rows = stats.select("session_id", F.explode(F.filter(entries, lambda e: e["n"] > 0)).alias("e"))
    return rows.select("session_id", "e.code", "e.severity", F.lit(None).cast("string").alias("where"), F.create_map(F.lit("count"), F.col("e.n").cast("string")).alias("detail"))


def plan_warnings(sessions: DataFrame, planned: DataFrame, stats: DataFrame) -> DataFrame:
    """All warnings of a plan: degradations, missing titles and identities, unmapped finishes, unreadable JSON."""
    untitled = rows_of(sessions.where("trim(title) = ''"), "title-missing")
    nobody = planned.where("is_step and (coalesce(provider, session_provider, '') = '' or coalesce(model, session_model, '') = '')").groupBy("session_id").agg(F.min_by("id", "msg_pos").alias("id"))
    known = ("stop", "tool-calls", "completed", "stream_recovery_discarded", "length")
    finished = planned.where(F.col("is_step") & ~F.col("finish").isin(*known))
    failed = finished.where("finish = 'failed'").select("session_id").distinct()
    odd = finished.where("finish <> 'failed'").select("session_id", "finish").distinct()
    return (
        degradations(stats)
        .unionByName(untitled)
        .unionByName(rows_of(nobody, "assistant-provenance-missing", where=F.col("id")))
        .unionByName(rows_of(failed, "turn-failed", "info"))
        .unionByName(rows_of(odd, "turn-end-unmapped", "info", F.create_map(F.lit("finish"), F.col("finish"))))
    )


def invalid_json(messages: DataFrame, parts: DataFrame) -> DataFrame:
    bad = lambda df: df.where(~F.coalesce("json_ok", F.lit(False)))
    return rows_of(bad(messages), "message-json-invalid", where=F.col("id")).unionByName(rows_of(bad(parts), "part-json-invalid", where=F.col("id")))


def counts(warnings: DataFrame) -> DataFrame:
    """(code, severity, n), most frequent first."""
    return warnings.groupBy("code", "severity").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "code")


def errors(warnings: DataFrame) -> DataFrame:
    return warnings.where("severity = 'error'")
