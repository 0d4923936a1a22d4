"""Queries of the session-log operators over the driver's tables, with their SQL.

The driver has no session logs, so two tables are relabelled. `conversations`
is a source of sessions (conv_id) without anchors; system rows are left out. `events`
is one of sessions (user_id) with anchors and tools: signup is a user's message
anchored to turn event_id % 5, view a text answer, click a finished tool call,
purchase one without a result, error a failed one. Where the data have no
counterpart (a stored log, a registry, faults) it is made from the rows by rule.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .checkpoint import cut, shared_dir
from .functions import ids as I
from .functions import json as J
from .operators import chain, digests, events, fidelity, normalize, pending, reconcile, report, scan, turns, validate
from .operators import warnings as W
from .sinks.store import merged_registry
from .sources import lines
from .sources.lines import late_results
from .sources.rollout import merged_windows, window_gaps

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- sources -----------------------------------------------------------------


def talk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations without system rows, as (session_id, conv_id, msg_pos, turn0, role, text)."""
    rows = _table(spark, sf_dir, "conversations").where("role <> 'system'")
    order = Window.partitionBy("conv_id").orderBy("turn")
    return rows.select(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("session_id"), "conv_id", (F.row_number().over(order).cast("long") - 1).alias("msg_pos"), F.col("turn").alias("turn0"), "role", "text")


_TALK = """
talk AS (SELECT 'c' || conv_id AS session_id, conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS msg_pos, turn AS turn0, role, text
         FROM conversations WHERE role <> 'system'),
seg AS (SELECT *, 1 + sum(opens) OVER (PARTITION BY session_id ORDER BY msg_pos) AS turn FROM
        (SELECT *, CASE WHEN role = 'user' AND lag(role) OVER (PARTITION BY session_id ORDER BY msg_pos) = 'assistant' THEN 1 ELSE 0 END AS opens FROM talk))"""


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as (session_id, event_id, msg_pos, type, anchor, time, role, props)."""
    rows = _table(spark, sf_dir, "events")
    rows = scan.dealt(rows, rows.count(), "user_id")
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return rows.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("session_id"),
        "event_id",
        (F.row_number().over(order).cast("long") - 1).alias("msg_pos"),
        F.col("event_type").alias("type"),
        F.when(F.col("event_type") == "signup", (F.col("event_id") % 5).cast("string")).alias("anchor"),
        F.expr("timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts)").alias("time"),
        F.when(F.col("event_type") == "signup", "user").otherwise("assistant").alias("role"),
        "props",
        "value",
    )


_ACTIVITY = """
act AS (SELECT 'u' || user_id AS session_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS msg_pos, event_type AS type,
               CASE WHEN event_type = 'signup' THEN (event_id % 5)::VARCHAR END AS anchor, epoch_us(ts) // 1000 AS time,
               CASE WHEN event_type = 'signup' THEN 'user' ELSE 'assistant' END AS role, props, value FROM events),
grp AS (SELECT *, last_value(anchor IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY msg_pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS key FROM act),
fst AS (SELECT *, min(msg_pos) OVER (PARTITION BY session_id, key) AS first FROM grp),
seg AS (SELECT *, dense_rank() OVER (PARTITION BY session_id ORDER BY first) AS turn FROM fst)"""

#: Positions of a segment in the queries on an endless session; small, so that the tables have many segments.
ENDLESS_ROWS = 1_000


def endless_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """activity with every second user in one session, x, which holds half of all rows."""
    rows = _table(spark, sf_dir, "events").withColumn("session_id", F.when(F.col("user_id") % 2 == 0, "x").otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string"))))
    placed = scan.numbered(rows, ["session_id"], ["ts", "event_id"], "msg_pos", ENDLESS_ROWS)
    return placed.select(
        "session_id",
        "event_id",
        "msg_pos",
        F.col("event_type").alias("type"),
        F.when(F.col("event_type") == "signup", (F.col("event_id") % 5).cast("string")).alias("anchor"),
        F.expr("timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts)").alias("time"),
        F.when(F.col("event_type") == "signup", "user").otherwise("assistant").alias("role"),
        "props",
        "value",
    )


_X = "CASE WHEN user_id % 2 = 0 THEN 'x' ELSE 'u' || user_id END"
_ENDLESS = _ACTIVITY.replace("'u' || user_id AS session_id", f"{_X} AS session_id").replace("PARTITION BY user_id", f"PARTITION BY {_X}")

_NO = {"string": ("turn_id", "origin", "semantics_kind", "visibility", "model", "provider", "mode", "agent", "finish", "cwd", "summary_title", "summary_body")}


def _messages(df: DataFrame) -> DataFrame:
    absent = {n: F.lit(None).cast("string") for n in _NO["string"] if n not in df.columns}
    return df.withColumns(absent | ({} if "usage" in df.columns else {"usage": F.lit(None).cast(events.USAGE)}) | {"json_ok": F.lit(True)})


def _parts(df: DataFrame) -> DataFrame:
    strings = ("text", "call_id", "tool_name", "status", "input", "input_kind", "output", "error", "mime", "url", "step_finish_reason")
    absent = {n: F.lit(None).cast("string") for n in strings if n not in df.columns} | {n: F.lit(None).cast("long") for n in ("tool_end_time", "size_bytes") if n not in df.columns}
    return df.withColumns(absent)


def talk_source(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sessions, messages and parts of conversations; every answer begins with a reasoning part of its whole text."""
    rows = talk(spark, sf_dir)
    created = F.col("conv_id") * 1000
    sessions = rows.groupBy("session_id", "conv_id").agg(F.max("turn0").alias("_last")).select(
        "session_id",
        F.when(F.col("conv_id") % 10 == 0, "").otherwise(F.concat(F.lit("Talk "), F.col("conv_id").cast("string"))).alias("title"),
        F.concat(F.lit("/w/"), (F.col("conv_id") % 5).cast("string")).alias("directory"),
        created.alias("created_at"),
        (created + F.col("_last")).alias("updated_at"),
        F.lit("sqlite").alias("source_kind"),
        *(F.lit(None).cast("string").alias(c) for c in ("project_id", "source_version", "task_type", "model", "provider")),
    )
    time = created + F.col("turn0")
    messages = _messages(rows.select("session_id", "msg_pos", F.concat(F.lit("m"), F.col("turn0").cast("string")).alias("id"), "role", time.alias("time"), F.lit(None).cast("long").alias("completed_time"), F.when(F.col("turn0") == 1, "compact").alias("origin")))
    piece = lambda kind: F.struct(F.lit(kind).alias("kind"), F.col("text"))
    pieces = F.when(F.col("role") == "assistant", F.array(piece("reasoning"), piece("text"))).otherwise(F.array(piece("text")))
    flat = rows.select("session_id", "msg_pos", "turn0", time.alias("time"), F.posexplode(pieces).alias("part_pos", "p"))
    parts = _parts(flat.select("session_id", "msg_pos", F.col("part_pos").cast("long").alias("part_pos"), F.concat(F.lit("m"), F.col("turn0").cast("string"), F.lit("-p"), F.col("part_pos").cast("string")).alias("id"), "p.kind", "time", "p.text"))
    return sessions, messages, parts


def activity_source(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sessions, messages and parts of events, or of the given rows of activity."""
    rows = activity(spark, sf_dir) if rows is None else rows
    null = lambda n: F.lit(None).cast("string").alias(n)
    sessions = rows.groupBy("session_id").agg(F.min("time").alias("created_at"), F.max("time").alias("updated_at")).select("session_id", F.col("session_id").alias("title"), F.lit("").alias("directory"), "created_at", "updated_at", F.lit("sqlite").alias("source_kind"), null("project_id"), null("source_version"), null("task_type"), F.lit("model-a").alias("model"), F.lit("maker").alias("provider"))
    id_ = F.concat(F.lit("e"), F.col("event_id").cast("string"))
    finish = F.when(F.col("role") == "assistant", F.when(F.col("event_id") % 7 == 0, "length").when(F.col("event_id") % 11 == 0, "failed").otherwise("stop"))
    messages = _messages(rows.select("session_id", "msg_pos", id_.alias("id"), "role", "time", F.lit(None).cast("long").alias("completed_time"), F.col("anchor").alias("turn_id"), finish.alias("finish")))
    tool = F.col("type").isin("click", "purchase", "error")
    parts = _parts(
        rows.select(
            "session_id", "msg_pos", F.lit(0).cast("long").alias("part_pos"), F.concat(id_, F.lit("-p0")).alias("id"), F.when(tool, "tool").otherwise("text").alias("kind"), "time",
            F.when(~tool, F.col("type")).alias("text"), F.when(tool, F.concat(F.lit("k"), F.col("event_id").cast("string"))).alias("call_id"), F.when(tool, F.col("type")).alias("tool_name"),
            F.when(tool, F.when(F.col("type") == "click", "completed").when(F.col("type") == "purchase", "running").otherwise("error")).alias("status"),
            F.when(tool & (F.col("event_id") % 3 > 0), F.when(F.col("event_id") % 3 == 1, F.col("props")).otherwise(F.col("type"))).alias("input"), F.when(tool & (F.col("event_id") % 3 > 0), "STRING").alias("input_kind"),
            F.when(F.col("type") == "click", F.when(F.col("event_id") % 2 == 0, F.col("type")).otherwise("")).alias("output"), F.when(F.col("type") == "error", F.col("type")).alias("error"),
        )
    )
    return sessions, messages, parts


def talk_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(planned, log, sessions) of conversations."""
    sessions, messages, parts = talk_source(spark, sf_dir)
    planned = events.planned_messages(sessions, messages, parts, anchored=False)
    return planned, events.event_log(planned, sessions), sessions


def activity_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    sessions, messages, parts = activity_source(spark, sf_dir)
    planned = events.planned_messages(sessions, messages, parts)
    return planned, events.event_log(planned, sessions), sessions


def _log_sql(source: str, title: str, tools: str) -> str:
    """CTEs ending in log(session_id, seq, type, turn, step, msg_pos) from seg(session_id, msg_pos, role, turn, ...)."""
    return f"""{source},
stp AS (SELECT *, 1 + coalesce(sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER (PARTITION BY session_id, turn ORDER BY msg_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bucket,
               sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER (PARTITION BY session_id, turn) AS steps FROM seg),
ev AS (
  SELECT session_id, 0 AS turn, 0 AS bucket, 0 AS phase, -1 AS m, 0 AS sub, 'session/title' AS type, NULL::BIGINT AS msg_pos FROM ({title})
  UNION ALL SELECT session_id, turn, 0, 0, -1, 0, 'turn/start', min(msg_pos) FROM stp GROUP BY session_id, turn
  UNION ALL SELECT session_id, turn, bucket, 1, -1, 0, 'step/start', msg_pos FROM stp WHERE role = 'assistant'
  UNION ALL SELECT session_id, turn, bucket, 2, msg_pos, 0, 'user/message', msg_pos FROM stp WHERE role = 'user'
  UNION ALL SELECT session_id, turn, bucket, 3, -1, 0, 'assistant/message', msg_pos FROM stp WHERE role = 'assistant'
  UNION ALL SELECT session_id, turn, bucket, 4, -1, 0, 'tool/call', msg_pos FROM stp WHERE role = 'assistant' AND {tools}
  UNION ALL SELECT session_id, turn, bucket, 4, -1, 1, 'tool/result', msg_pos FROM stp WHERE role = 'assistant' AND {tools}
  UNION ALL SELECT session_id, turn, bucket, 5, -1, 0, 'step/end', msg_pos FROM stp WHERE role = 'assistant'
  UNION ALL SELECT session_id, turn, max(steps) + 2, 9, -1, 0, 'turn/end', max(msg_pos) FROM stp GROUP BY session_id, turn),
log AS (SELECT session_id, (row_number() OVER (PARTITION BY session_id ORDER BY turn, bucket, phase, m, sub) - 1)::BIGINT AS seq, type, turn::BIGINT AS turn_no, bucket::BIGINT AS bucket, msg_pos FROM ev)"""


_TALK_LOG = _log_sql(_TALK, "SELECT DISTINCT session_id FROM talk WHERE conv_id % 10 <> 0", "false")
_ENDLESS_LOG = _log_sql(_ENDLESS, "SELECT DISTINCT session_id FROM act", "type IN ('click', 'purchase', 'error')")
_ACTIVITY_LOG = _log_sql(_ACTIVITY, "SELECT DISTINCT session_id FROM act", "type IN ('click', 'purchase', 'error')")


# --- turns, steps, logs --------------------------------------------------------


@query(f"WITH {_TALK} SELECT session_id, turn::BIGINT AS turn, count(*)::BIGINT AS messages, count(*) FILTER (role = 'assistant')::BIGINT AS steps, sum(length(text))::BIGINT AS chars FROM seg GROUP BY session_id, turn")
def turn_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turns.segment_turns(talk(spark, sf_dir))
    return rows.groupBy("session_id", "turn").agg(F.count("*").alias("messages"), F.count_if(F.col("role") == "assistant").alias("steps"), F.sum(F.length("text")).alias("chars"))


@query(f"WITH {_ACTIVITY} SELECT session_id, msg_pos::BIGINT AS msg_pos, turn::BIGINT AS turn FROM seg")
def anchored_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.anchored_turns(activity(spark, sf_dir), anchor="anchor").select("session_id", "msg_pos", "turn")


@query(f"WITH {_ACTIVITY_LOG} SELECT session_id, msg_pos::BIGINT AS msg_pos, CASE WHEN role = 'assistant' THEN bucket END::BIGINT AS step, bucket::BIGINT AS bucket, steps::BIGINT AS turn_steps FROM stp")
def step_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turns.anchored_turns(activity(spark, sf_dir), anchor="anchor").withColumn("kinds", F.array(F.lit("text")))
    rows = turns.numbered_steps(rows.withColumn("is_step", turns.is_step(F.col("role"), F.col("kinds"))))
    return rows.select("session_id", "msg_pos", "step", "bucket", "turn_steps")


@query(f"WITH {_TALK_LOG} SELECT session_id, msg_pos::BIGINT AS msg_pos, turn::BIGINT AS turn, bucket::BIGINT AS bucket, bucket > steps AS trailing FROM stp WHERE role = 'user'")
def user_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turns.segment_turns(talk(spark, sf_dir)).withColumn("is_step", F.col("role") == "assistant")
    return turns.numbered_steps(rows).where("role = 'user'").select("session_id", "msg_pos", "turn", "bucket", (F.col("bucket") > F.col("turn_steps")).alias("trailing"))


_SHOWN = "SELECT session_id, seq, type, CASE WHEN type NOT IN ('session/title', 'user/message') THEN turn_no END AS turn, CASE WHEN type NOT IN ('session/title', 'user/message', 'turn/start', 'turn/end') THEN bucket END AS step FROM log"


@query(f"WITH {_TALK_LOG} {_SHOWN}")
def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return talk_log(spark, sf_dir)[1].select("session_id", "seq", "type", "turn", "step")


@query(f"WITH {_ACTIVITY_LOG} {_SHOWN}")
def event_log_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity_log(spark, sf_dir)[1].select("session_id", "seq", "type", "turn", "step")


@query(f"WITH {_ENDLESS_LOG} SELECT session_id, msg_pos::BIGINT AS msg_pos, turn::BIGINT AS turn, CASE WHEN role = 'assistant' THEN bucket END::BIGINT AS step, bucket::BIGINT AS bucket, steps::BIGINT AS turn_steps FROM stp")
def endless_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns by anchors and steps where one session holds half of all rows, in segments."""
    rows = turns.anchored_turns(endless_activity(spark, sf_dir), anchor="anchor", segment_rows=ENDLESS_ROWS)
    rows = turns.numbered_steps(rows.withColumn("is_step", F.col("role") == "assistant"), segment_rows=ENDLESS_ROWS)
    return rows.select("session_id", "msg_pos", "turn", "step", "bucket", "turn_steps")


@query(
    f"""WITH {_ENDLESS}, sp AS (SELECT *, last_value(CASE WHEN role IN ('user', 'assistant') THEN role END IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY msg_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS spoke FROM act)
SELECT session_id, msg_pos::BIGINT AS msg_pos, (1 + sum(CASE WHEN role = 'user' AND spoke = 'assistant' THEN 1 ELSE 0 END) OVER (PARTITION BY session_id ORDER BY msg_pos))::BIGINT AS turn FROM sp"""
)
def endless_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns without anchors where one session holds half of all rows, in segments."""
    return turns.segment_turns(endless_activity(spark, sf_dir), segment_rows=ENDLESS_ROWS).select("session_id", "msg_pos", "turn")


def endless_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sessions, messages and parts are all made from these rows
    sessions, messages, parts = activity_source(spark, sf_dir, cut(endless_activity(spark, sf_dir)))
    planned = events.planned_messages(sessions, messages, parts, segment_rows=ENDLESS_ROWS)
    return events.event_log(planned, sessions)


_TIMES = """, u AS (SELECT session_id, turn, bucket, min(msg_pos) AS p FROM stp WHERE role = 'user' GROUP BY session_id, turn, bucket)
SELECT l.session_id, l.seq, l.type, CASE WHEN l.type NOT IN ('session/title', 'user/message') THEN l.turn_no END AS turn, CASE WHEN l.type NOT IN ('session/title', 'user/message', 'turn/start', 'turn/end') THEN l.bucket END AS step,
  CASE WHEN l.type = 'session/title' THEN (SELECT min(time) FROM act a WHERE a.session_id = l.session_id) WHEN l.type = 'step/start' THEN coalesce(ua.time, a.time) ELSE a.time END::BIGINT AS time
FROM log l LEFT JOIN act a ON a.session_id = l.session_id AND a.msg_pos = l.msg_pos
LEFT JOIN u ON l.type = 'step/start' AND u.session_id = l.session_id AND u.turn = l.turn_no AND u.bucket = l.bucket
LEFT JOIN act ua ON ua.session_id = u.session_id AND ua.msg_pos = u.p"""


@query(f"WITH {_ENDLESS_LOG}{_TIMES}")
def endless_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log where one session holds half of all rows, in segments."""
    return endless_log(spark, sf_dir).select("session_id", "seq", "type", "turn", "step", "time")


@query(
    f"""WITH {_ACTIVITY_LOG}, u AS (SELECT session_id, turn, bucket, min(msg_pos) AS p FROM stp WHERE role = 'user' GROUP BY session_id, turn, bucket)
SELECT l.session_id, l.seq, l.type, CASE WHEN l.type = 'session/title' THEN (SELECT min(time) FROM act a WHERE a.session_id = l.session_id)
  WHEN l.type = 'step/start' THEN coalesce(ua.time, a.time) ELSE a.time END::BIGINT AS time
FROM log l LEFT JOIN act a ON a.session_id = l.session_id AND a.msg_pos = l.msg_pos
LEFT JOIN u ON l.type = 'step/start' AND u.session_id = l.session_id AND u.turn = l.turn_no AND u.bucket = l.bucket
LEFT JOIN act ua ON ua.session_id = u.session_id AND ua.msg_pos = u.p"""
)
def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity_log(spark, sf_dir)[1].select("session_id", "seq", "type", "time")


@query(
    f"""WITH {_ACTIVITY}, f AS (SELECT *, CASE WHEN event_id % 7 = 0 THEN 'length' WHEN event_id % 11 = 0 THEN 'failed' ELSE 'stop' END AS finish FROM seg WHERE role = 'assistant'),
t AS (SELECT DISTINCT session_id, turn FROM seg), l AS (SELECT session_id, turn, arg_max(finish, msg_pos) AS finish FROM f GROUP BY session_id, turn)
SELECT session_id, turn::BIGINT AS turn, CASE finish WHEN 'length' THEN 'max-tokens' WHEN 'failed' THEN 'error' ELSE 'completed' END AS reason_kind, CASE WHEN finish = 'failed' THEN 'UNKNOWN' END AS reason_code FROM t LEFT JOIN l USING (session_id, turn)"""
)
def turn_end_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity_log(spark, sf_dir)[1].where("type = 'turn/end'").select("session_id", "turn", "reason_kind", "reason_code")


@query(
    f"""WITH {_ACTIVITY_LOG} SELECT l.session_id, l.seq, [l.seq - 1] AS source_event_seqs, a.type = 'error' OR a.type = 'purchase' AS is_error, CASE WHEN a.type = 'purchase' THEN 'TOOL_OUTCOME_UNKNOWN' END AS error_code,
CASE WHEN a.type = 'purchase' THEN 'No result was recorded for this call (status: running); its outcome is unknown.' WHEN a.type = 'error' THEN 'error' WHEN a.event_id % 2 = 0 THEN 'click' ELSE '(no output)' END AS text
FROM log l JOIN act a ON a.session_id = l.session_id AND a.msg_pos = l.msg_pos WHERE l.type = 'tool/result'"""
)
def tool_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = activity_log(spark, sf_dir)[1].where("type = 'tool/result'")
    return rows.select("session_id", "seq", "source_event_seqs", "is_error", "error_code", F.get("blocks", F.lit(0))["text"].alias("text"))


@query(
    f"""WITH {_ACTIVITY}, k AS (SELECT *, CASE WHEN event_id % 3 = 0 THEN 'absent' WHEN event_id % 3 = 1 AND json_valid(props) THEN 'verbatim' ELSE 'wrapped' END AS how FROM act WHERE type IN ('click', 'purchase', 'error'))
SELECT session_id, event_id, how, CASE how WHEN 'absent' THEN '{{}}' WHEN 'verbatim' THEN props ELSE '{{"_raw":"' || (CASE WHEN event_id % 3 = 1 THEN props ELSE type END) || '"}}' END AS arguments FROM k"""
)
def tool_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = activity(spark, sf_dir).where("type in ('click', 'purchase', 'error')")
    given = F.when(F.col("event_id") % 3 > 0, F.when(F.col("event_id") % 3 == 1, F.col("props")).otherwise(F.col("type")))
    text, how = events.tool_arguments(given, F.when(given.isNotNull(), "STRING"))
    return rows.select("session_id", "event_id", how.alias("how"), text.alias("arguments"))


@query(
    f"""WITH {_ACTIVITY}, c AS (SELECT *, event_id % 4 AS call_id FROM act WHERE type = 'click'), r AS (SELECT *, event_id % 4 AS call_id FROM act WHERE type IN ('purchase', 'error')),
b AS (SELECT r.session_id, r.call_id, r.msg_pos AS place, r.type, (SELECT max(c.msg_pos) FROM c WHERE c.session_id = r.session_id AND c.call_id = r.call_id AND c.msg_pos < r.msg_pos) AS pos FROM r),
l AS (SELECT session_id, pos, arg_max(type, place) AS type FROM b WHERE pos IS NOT NULL GROUP BY session_id, pos)
SELECT c.session_id, c.msg_pos::BIGINT AS pos, c.call_id::VARCHAR AS call_id, l.type AS result_text, l.type = 'error' AS result_error FROM c LEFT JOIN l ON l.session_id = c.session_id AND l.pos = c.msg_pos"""
)
def tool_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = activity(spark, sf_dir).withColumn("call_id", (F.col("event_id") % 4).cast("string")).withColumn("pos", F.col("msg_pos"))
    results = rows.where("type in ('purchase', 'error')").select("session_id", "pos", "call_id", F.col("type").alias("text"), (F.col("type") == "error").alias("is_error"), "time")
    return late_results(rows.where("type = 'click'").select("session_id", "pos", "call_id"), results).select("session_id", "pos", "call_id", "result_text", "result_error")


@query(
    f"""WITH {_TALK}, n AS (SELECT session_id, count(*) AS size FROM talk GROUP BY session_id),
w AS (SELECT t.session_id, r.record, t.msg_pos AS idx, t.msg_pos - greatest(r.record * 3 - 2, 0) AS pos, t.text FROM talk t JOIN n USING (session_id) CROSS JOIN LATERAL (SELECT unnest(range(0, (n.size + 2) // 3)) AS record) r
      WHERE t.msg_pos >= greatest(r.record * 3 - 2, 0) AND t.msg_pos < least(r.record * 3 + 3, n.size) AND r.record * 3 < n.size),
z AS (SELECT session_id, record, count(*) AS size FROM w GROUP BY session_id, record)
SELECT w.session_id, w.idx::BIGINT AS idx, min(w.record)::BIGINT AS record, bool_or(w.pos = z.size - 1) AS terminal FROM w JOIN z USING (session_id, record) GROUP BY w.session_id, w.idx"""
)
def window_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of up to five messages, three apart, so that neighbours overlap by two."""
    rows = talk(spark, sf_dir)
    records = rows.select("session_id", "msg_pos", "text", F.explode(F.array(F.floor(F.col("msg_pos") / 3), F.floor((F.col("msg_pos") + 2) / 3))).alias("record")).distinct()
    longest = rows.groupBy("session_id").agg(F.count("*").alias("n"))
    records = records.join(longest, "session_id").where("record * 3 < n").drop("n")
    records = records.withColumn("idx", F.col("msg_pos")).withColumn("pos", F.col("msg_pos") - F.greatest(F.col("record") * 3 - 2, F.lit(0)))
    sized = records.withColumn("size", F.count("*").over(Window.partitionBy("session_id", "record")))
    return merged_windows(sized).select("session_id", "idx", "record", "terminal")


@query(
    f"""WITH {_ACTIVITY}, r AS (SELECT session_id, msg_pos AS record, msg_pos * 3 + event_id % 3 AS start, 2 + event_id % 2 AS size FROM act)
SELECT session_id, bool_or(gap) AS gap FROM (SELECT session_id, coalesce(lag(start + size) OVER (PARTITION BY session_id ORDER BY record) < start, false) AS gap FROM r) GROUP BY session_id"""
)
def window_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = activity(spark, sf_dir).select("session_id", F.col("msg_pos").alias("record"), (F.col("msg_pos") * 3 + F.col("event_id") % 3).alias("offset"), (2 + F.col("event_id") % 2).alias("size"))
    return window_gaps(rows)


@query(f"WITH {_ACTIVITY} SELECT session_id, msg_pos::BIGINT AS msg_pos, coalesce(last_value(CASE WHEN type = 'view' THEN time END IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY msg_pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)::BIGINT AS carried FROM act")
def carried_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("session_id").orderBy("msg_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.when(F.col("type") == "view", F.col("time"))
    return activity(spark, sf_dir).select("session_id", "msg_pos", F.coalesce(F.last(own, ignorenulls=True).over(order), F.lit(0)).alias("carried"))


# --- sources and normalization ---------------------------------------------------


def stored_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """conversations as stored session, message and part tables with JSON payloads."""
    rows = talk(spark, sf_dir)
    session = rows.groupBy("session_id", "conv_id").agg(F.max("turn0").alias("_last")).select(
        F.col("session_id").alias("id"), F.concat(F.lit("Talk "), F.col("conv_id").cast("string")).alias("title"), F.when(F.col("conv_id") % 2 == 0, F.lit("")).otherwise(F.lit("/d")).alias("directory"),
        F.when(F.col("conv_id") % 3 == 0, F.lit("/p")).alias("path"), (F.col("conv_id") * 1000).alias("time_created"), (F.col("conv_id") * 1000 + F.col("_last")).alias("time_updated"),
    )
    id_ = F.concat("session_id", F.lit("-"), F.col("turn0").cast("string"))
    data = F.to_json(F.struct("role", F.struct(F.when(F.col("turn0") % 3 == 0, F.col("turn0").cast("string")).alias("turnID")).alias("anchor"), F.when(F.col("turn0") % 2 == 0, F.lit("m1")).alias("modelID"), F.struct(F.lit("m2").alias("id"), F.lit("p2").alias("provider")).alias("model"), F.struct((F.col("turn0") * 10).alias("start")).alias("time"), F.struct(F.col("turn0").alias("inputTokens"), F.struct((F.col("turn0") + 1).alias("read")).alias("cache")).alias("tokens")))
    message = rows.select(id_.alias("id"), "session_id", F.when(F.col("turn0") % 5 > 0, F.col("turn0")).alias("sequence"), F.col("turn0").alias("time_created"), data.alias("data"))
    kind = F.when(F.col("turn0") % 4 == 0, "thinking").when(F.col("turn0") % 4 == 1, "text").when(F.col("turn0") % 4 == 2, "tool_call").otherwise("timeline")
    body = F.to_json(F.struct(kind.alias("type"), F.when(kind == "text", F.lit("said")).alias("text"), F.when(kind == "thinking", F.lit("thought")).alias("thinking"), F.when(kind == "tool_call", F.concat(F.lit("k"), F.col("turn0").cast("string"))).alias("callId"), F.when(kind == "tool_call", F.struct(F.struct(F.col("turn0").alias("n")).alias("args"), F.lit("out").alias("output"))).alias("state")))
    part = rows.select(F.concat(id_, F.lit("-p")).alias("id"), id_.alias("message_id"), "session_id", F.lit(None).cast("long").alias("sequence"), F.when(F.col("turn0") % 2 == 0, F.col("turn0") + 5).alias("time_created"), body.alias("data"))
    return session, message, part


@query(
    f"""WITH {_TALK} SELECT session_id, 'Talk ' || conv_id AS title, CASE WHEN conv_id % 2 <> 0 THEN '/d' WHEN conv_id % 3 = 0 THEN '/p' ELSE '' END AS directory, (conv_id * 1000)::BIGINT AS created_at, (conv_id * 1000 + max(turn0))::BIGINT AS updated_at,
count(*)::BIGINT AS message_count, count(*) FILTER (turn0 % 4 = 0)::BIGINT AS reasoning_count, 0::BIGINT AS tool_count FROM talk GROUP BY session_id, conv_id"""
)
def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.inventory(*stored_tables(spark, sf_dir)).select("session_id", "title", "directory", "created_at", "updated_at", "message_count", "reasoning_count", "tool_count")


@query(
    f"""WITH {_TALK} SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY CASE WHEN turn0 % 5 > 0 THEN turn0 ELSE 0 END, turn0, session_id || '-' || turn0) - 1 AS msg_pos, session_id || '-' || turn0 AS id, role,
CASE WHEN turn0 % 3 = 0 THEN turn0::VARCHAR END AS turn_id, CASE WHEN turn0 % 2 = 0 THEN 'm1' ELSE 'm2' END AS model, 'p2' AS provider, (turn0 * 10)::BIGINT AS completed_time, turn0::BIGINT AS input_tokens, (turn0 + 1)::BIGINT AS cache_read FROM talk"""
)
def normalized_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalize.normalized_messages(stored_tables(spark, sf_dir)[1])
    return rows.select("session_id", "msg_pos", "id", "role", "turn_id", "model", "provider", "completed_time", F.col("usage.input").alias("input_tokens"), F.col("usage.cache_read").alias("cache_read"))


@query(
    f"""WITH {_TALK} SELECT session_id, session_id || '-' || turn0 || '-p' AS id, CASE turn0 % 4 WHEN 0 THEN 'reasoning' WHEN 1 THEN 'text' WHEN 2 THEN 'tool' ELSE 'timeline' END AS kind, CASE turn0 % 4 WHEN 0 THEN 'thought' WHEN 1 THEN 'said' END AS text,
CASE WHEN turn0 % 2 = 0 THEN turn0 + 5 ELSE turn0 END::BIGINT AS time, CASE WHEN turn0 % 4 = 2 THEN 'k' || turn0 END AS call_id, CASE WHEN turn0 % 4 = 2 THEN 'unknown-tool' END AS tool_name, CASE WHEN turn0 % 4 = 2 THEN 'completed' END AS status,
CASE WHEN turn0 % 4 = 2 THEN '{{"n":' || turn0 || '}}' END AS input, CASE WHEN turn0 % 4 = 2 THEN 'OBJECT' END AS input_kind, CASE WHEN turn0 % 4 = 2 THEN 'out' END AS output FROM talk"""
)
def normalized_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, message, part = stored_tables(spark, sf_dir)
    rows = normalize.normalized_parts(part, normalize.normalized_messages(message))
    return rows.select("session_id", "id", "kind", "text", "time", "call_id", "tool_name", "status", "input", "input_kind", "output")


@query(
    """SELECT event_id, coalesce(json_extract_string(props, '$.missing'), json_extract_string(props, '$.k'), json_extract_string(props, '$.page')) AS picked, CASE WHEN json_type(props, '$.k') = 'VARCHAR' THEN json_extract_string(props, '$.k') END AS text,
coalesce(CASE WHEN json_type(props, '$.k') = 'VARCHAR' THEN nullif(json_extract_string(props, '$.k'), '') END, CASE WHEN json_type(props, '$.page') = 'VARCHAR' THEN nullif(json_extract_string(props, '$.page'), '') END) AS filled FROM events"""
)
def json_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = J.parsed(F.col("props"))
    return _table(spark, sf_dir, "events").select("event_id", F.coalesce(*(F.try_variant_get(J.at(v, p), "$", "string") for p in ("$.missing", "$.k", "$.page"))).alias("picked"), J.pick_string(v, "$.k", "$.page").alias("text"), J.pick_text(v, "$.k", "$.page").alias("filled"))


@query(
    f"""WITH {_TALK}, a AS ({"WITH " + _ACTIVITY + " SELECT session_id, 'legacy' AS source_kind, min(time)::BIGINT AS created_at, max(time)::BIGINT AS updated_at, NULL::BIGINT AS message_count FROM act GROUP BY session_id"})
SELECT session_id, 'sqlite' AS source_kind, (conv_id * 1000)::BIGINT AS created_at, (conv_id * 1000 + max(turn0))::BIGINT AS updated_at, count(*)::BIGINT AS message_count FROM talk GROUP BY session_id, conv_id UNION ALL SELECT * FROM a"""
)
def source_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = normalize.inventory(*stored_tables(spark, sf_dir)).select("session_id", "source_kind", "created_at", "updated_at", "message_count")
    old = activity_source(spark, sf_dir)[0].withColumn("source_kind", F.lit("legacy")).select("session_id", "source_kind", "created_at", "updated_at")
    return first.unionByName(old, allowMissingColumns=True)


@query("SELECT event_id, (epoch_us(ts) // 1000)::BIGINT AS read, 0::BIGINT AS unreadable FROM events")
def iso_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))
    return _table(spark, sf_dir, "events").select("event_id", J.iso_millis(text).alias("read"), J.iso_millis(F.col("props")).alias("unreadable"))


@query(
    """WITH f AS (SELECT conv_id % 8 AS file, conv_id, turn, row_number() OVER (PARTITION BY conv_id % 8 ORDER BY conv_id, turn) - 1 AS n FROM conversations)
SELECT file, n::BIGINT AS line, n::BIGINT AS record, conv_id, turn, true AS json_ok FROM f UNION ALL SELECT file, count(*)::BIGINT, count(*)::BIGINT, NULL, NULL, false FROM f GROUP BY file"""
)
def line_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations written as JSON lines, eight files that each end in a torn line, and read again."""
    rows = _table(spark, sf_dir, "conversations").select((F.col("conv_id") % 8).alias("file"), "conv_id", "turn", F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("value"))
    torn = rows.select("file", F.lit(None).cast("long").alias("conv_id"), F.lit(None).cast("long").alias("turn"), F.lit('{"conv_id":').alias("value")).distinct()
    folder = f"{shared_dir(spark)}/lines-{uuid.uuid4().hex}"
    rows.unionByName(torn).repartition("file").sortWithinPartitions("file", F.col("conv_id").asc_nulls_last(), "turn").select("file", "value").write.partitionBy("file").text(folder)
    read = lines.records(spark, folder, "part-*", recursive=True)
    field = lambda n: F.get_json_object("data", f"$.{n}").cast("long").alias(n)
    return read.select(F.regexp_extract("path", "file=([0-9]+)", 1).cast("long").alias("file"), "line", "record", F.when(F.col("json_ok"), field("conv_id")).alias("conv_id"), F.when(F.col("json_ok"), field("turn")).alias("turn"), "json_ok")


# --- ids and digests --------------------------------------------------------------

_UUID = "(substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', (('0x' || substr(h, 17, 1))::INT % 4) + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12))"


@query(f"WITH {_TALK}, h AS (SELECT DISTINCT session_id, sha1('{I.NAMESPACE}' || chr(0) || 'session/' || session_id) AS h FROM talk) SELECT session_id, 'session-' || {_UUID} AS target_id, substr(sha256(session_id), 1, 16) AS short FROM h")
def session_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return talk(spark, sf_dir).select("session_id").distinct().select("session_id", I.target_session_id(F.col("session_id")).alias("target_id"), I.short_hash(F.col("session_id")).alias("short"))


@query(
    f"""WITH {_ACTIVITY}, n AS (SELECT session_id, event_id, 'message/' || session_id || '/' || CASE WHEN role = 'user' THEN 'user' ELSE 'assistant' END || '/e' || event_id AS name FROM act),
h AS (SELECT session_id, event_id, sha1('{I.NAMESPACE}' || chr(0) || name) AS h FROM n) SELECT session_id, event_id, {_UUID} AS message_id FROM h"""
)
def message_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("role") == "user", "user").otherwise("assistant")
    return activity(spark, sf_dir).select("session_id", "event_id", I.message_id(F.col("session_id"), kind, F.concat(F.lit("e"), F.col("event_id").cast("string"))).alias("message_id"))


_CONTENT = """
txt AS (SELECT l.session_id, l.seq, l.type, l.turn_no, l.bucket, CASE l.type
  WHEN 'turn/start' THEN '{"turn":' || l.turn_no || ',"type":"turn/start"}' WHEN 'turn/end' THEN '{"reason_kind":"completed","turn":' || l.turn_no || ',"type":"turn/end"}'
  WHEN 'step/start' THEN '{"step":' || l.bucket || ',"turn":' || l.turn_no || ',"type":"step/start"}' WHEN 'step/end' THEN '{"step":' || l.bucket || ',"turn":' || l.turn_no || ',"type":"step/end"}'
  WHEN 'user/message' THEN '{"blocks":[{"type":"text","text":' || to_json(t.text) || '}],"message_id":"' || i.id || '",' || CASE WHEN t.turn0 = 1 THEN '"plugin":"importer",' ELSE '' END || '"role":"user","source_kind":"' || CASE WHEN t.turn0 = 1 THEN 'plugin' ELSE 'user' END || '","type":"user/message"}'
  WHEN 'assistant/message' THEN '{"blocks":[' || '{"type":"reasoning","text":' || to_json(t.text) || '},' || '{"type":"text","text":' || to_json(t.text) || '}],"message_id":"' || i.id
       || '","model":"unknown","provider":"importer","role":"assistant","source_kind":"model","step":' || l.bucket || ',"turn":' || l.turn_no || ',"type":"assistant/message"}' END AS text
  FROM log l LEFT JOIN talk t ON t.session_id = l.session_id AND t.msg_pos = l.msg_pos
  LEFT JOIN (SELECT session_id, msg_pos, UUID AS id FROM (SELECT session_id, msg_pos, sha1('NAMESPACE' || chr(0) || 'message/' || session_id || '/' || CASE WHEN role = 'assistant' THEN 'assistant' WHEN turn0 = 1 THEN 'injected' ELSE 'user' END || '/m' || turn0) AS h FROM talk)) i
    ON i.session_id = l.session_id AND i.msg_pos = l.msg_pos),
slc AS (SELECT session_id, turn_no AS turn, sha256(string_agg(sha256(text), '' ORDER BY seq)) AS digest, count(*)::BIGINT AS event_count FROM txt WHERE type <> 'session/title' GROUP BY session_id, turn_no)""".replace("UUID", _UUID).replace("NAMESPACE", I.NAMESPACE)


@query(f"WITH {_TALK_LOG}, {_CONTENT} SELECT session_id, turn, digest, event_count, false AS contentless FROM slc")
def turn_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests.turn_slices(talk_log(spark, sf_dir)[1]).drop("slice")


@query()
def log_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field of a log; no SQL, as its JSON is Spark's. Tested by changing one field."""
    return digests.log_digest(activity_log(spark, sf_dir)[1])


@query(f"WITH {_TALK} SELECT session_id, {0}::INT AS version, (conv_id * 1000)::BIGINT AS created_at, '/w/' || conv_id % 5 AS cwd, 0::INT AS delegation_depth FROM talk GROUP BY session_id, conv_id")
def log_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.log_headers(talk_source(spark, sf_dir)[0]).drop("target_id")


# --- reconcile, write, verify --------------------------------------------------------


def stored_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(plan, its headers, stored log, its headers): the stored log is an older state of the plan.

    It holds the first two turns. Where conv_id % 7 = 0 its first answer was
    rewritten, % 11 = 0 it has the whole plan and one turn more, % 13 = 0 there is
    none, % 17 = 0 its header's time differs, % 5 = 0 its title is another.
    """
    _, plan, sessions = talk_log(spark, sf_dir)
    plan = cut(plan)
    conv = F.substring("session_id", F.lit(2), F.length("session_id")).cast("long")
    plan = plan.withColumn("conv_id", conv)
    sliced = digests.sliced(plan)
    base = sliced.where("(slice is null or slice <= 2 or conv_id % 11 = 0) and conv_id % 13 <> 0").drop("slice")
    rewritten = (F.col("conv_id") % 7 == 0) & (F.col("type") == "assistant/message") & (F.col("turn") == 1)
    base = base.withColumn("model", F.when(rewritten, "other").otherwise(F.col("model"))).withColumn("title", F.when(F.col("conv_id") % 5 == 0, F.concat("title", F.lit(" old"))).otherwise(F.col("title")))
    more = plan.where("conv_id % 11 = 0 and conv_id % 13 <> 0 and turn = 1 and type in ('turn/start', 'turn/end')")
    more = more.withColumn("turn", F.lit(99).cast("long")).withColumn("seq", F.when(F.col("type") == "turn/start", 100_000).otherwise(100_001).cast("long"))
    both = base.unionByName(more)
    seq = F.row_number().over(Window.partitionBy("session_id").orderBy("seq")).cast("long") - 1
    stored = cut(both.withColumn("seq", seq).drop("conv_id"))
    headers = events.log_headers(sessions)
    old = headers.where(conv % 13 != 0).withColumn("created_at", F.col("created_at") + F.when(conv % 17 == 0, 1).otherwise(0))
    return plan.drop("conv_id"), headers, stored, old


_RECONCILE = f"""WITH {_TALK_LOG}, {_CONTENT},
n AS (SELECT session_id, any_value(conv_id) AS conv_id, max(turn) AS turns FROM seg GROUP BY session_id),
k AS (SELECT session_id, conv_id, turns, CASE WHEN conv_id % 13 = 0 THEN 0 WHEN conv_id % 11 = 0 THEN turns + 1 ELSE least(turns, 2) END AS stored,
             EXISTS (SELECT 1 FROM seg s WHERE s.session_id = n.session_id AND s.turn = 1 AND s.role = 'assistant') AS answered FROM n),
m AS (SELECT *, conv_id % 13 <> 0 AND conv_id % 5 = 0 AND conv_id % 10 <> 0 AS renamed FROM k),
d AS (SELECT *, CASE WHEN conv_id % 13 = 0 THEN 'create' WHEN stored > turns THEN 'conflict' WHEN conv_id % 7 = 0 AND answered THEN 'conflict' WHEN conv_id % 17 = 0 THEN 'conflict' WHEN stored = turns AND NOT renamed THEN 'skip' ELSE 'append' END AS mode,
   CASE WHEN conv_id % 13 = 0 THEN NULL WHEN stored > turns THEN 'source-shrank' WHEN conv_id % 7 = 0 AND answered THEN 'turn-content-rewritten' WHEN conv_id % 17 = 0 THEN 'header-created-at-differs' END AS reason FROM m),
c AS (SELECT l.session_id, count(*) AS consumed FROM log l JOIN d USING (session_id) WHERE l.turn_no <= d.stored OR l.type = 'session/title' GROUP BY l.session_id)"""


@query(
    f"{_RECONCILE} SELECT session_id, mode, reason, CASE WHEN reason = 'turn-content-rewritten' THEN 0 END::BIGINT AS turn_index, turns::BIGINT AS planned_turns, stored::BIGINT AS stored_turns, mode = 'append' AND renamed AS title_changed FROM d"
)
def reconcile_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reconcile.decisions(*stored_log(spark, sf_dir))
    return rows.select("session_id", "mode", "reason", F.col("turn_index").cast("long").alias("turn_index"), "planned_turns", "stored_turns", "title_changed")


@query(
    f"{_RECONCILE} SELECT session_id, mode, reason, CASE WHEN reason = 'turn-content-rewritten' THEN 0 END::BIGINT AS turn_index, turns::BIGINT AS planned_turns, stored::BIGINT AS stored_turns, mode = 'append' AND renamed AS title_changed FROM d"
)
def chain_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `reconcile_decisions`, from the heads of the stored logs; only rewritten logs are read."""
    plan, headers, stored, old = stored_log(spark, sf_dir)
    rows = chain.decisions(plan, headers, cut(chain.heads_of(stored)), old, lambda ids: stored.join(ids, "session_id", "left_semi"))
    return rows.select("session_id", "mode", "reason", "turn_index", "planned_turns", "stored_turns", "title_changed")


@query(
    f"""WITH {_TALK_LOG}, {_CONTENT}, o AS (SELECT session_id, turn, event_count, list(digest) OVER (PARTITION BY session_id ORDER BY turn) AS digests, sum(event_count) OVER (PARTITION BY session_id ORDER BY turn) AS events_to FROM slc)
SELECT session_id, (len(digests) - 1)::BIGINT AS position, list_reduce(digests, lambda a, b: sha256(a || b), '') AS chain, events_to::BIGINT AS events_to FROM o"""
)
def turn_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain value at each turn."""
    return chain.chained(digests.turn_slices(talk_log(spark, sf_dir)[1])).select("session_id", "position", "chain", "events_to")


@query(
    f"""{_RECONCILE}, t AS (SELECT l.session_id, l.seq AS o, l.type, l.turn_no, d.mode, CASE WHEN d.mode = 'create' THEN 0 ELSE c.consumed END AS start FROM log l JOIN d USING (session_id) LEFT JOIN c USING (session_id)
  WHERE (d.mode = 'create' OR d.mode = 'append' AND l.seq >= c.consumed) UNION ALL SELECT l.session_id, -1, l.type, l.turn_no, d.mode, c.consumed FROM log l JOIN d USING (session_id) JOIN c USING (session_id) WHERE d.mode = 'append' AND d.renamed AND l.type = 'session/title')
SELECT session_id, (row_number() OVER (PARTITION BY session_id ORDER BY o) - 1 + start)::BIGINT AS seq, type FROM t"""
)
def append_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan, headers, stored, old = stored_log(spark, sf_dir)
    return reconcile.increments(plan, reconcile.decisions(plan, headers, stored, old)).select("session_id", "seq", "type")


@query(f"WITH {_ACTIVITY_LOG} SELECT session_id, (seq + 1000)::BIGINT AS seq, [seq + 999] AS source_event_seqs FROM log WHERE type = 'tool/result'")
def resequenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the numbering asks for the log three times
    log = cut(activity_log(spark, sf_dir)[1].select("session_id", "seq", "type", "source_event_seqs")).withColumn("_order", F.col("seq")).withColumn("start", F.lit(1000).cast("long"))
    return reconcile.restamped(log, "start").where("type = 'tool/result'").select("session_id", "seq", "source_event_seqs")


def registry_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of conversations: none where conv_id % 4 = 0, moved % 4 = 1, a conflict where % 6 = 2."""
    rows = talk_source(spark, sf_dir)[0]
    conv = F.substring("session_id", F.lit(2), F.length("session_id")).cast("long")
    return rows.where(conv % 4 != 0).select(
        F.col("session_id").alias("source_id"), I.target_session_id(F.col("session_id")).alias("target_id"), F.lit("").alias("variant"), "title", F.col("directory").alias("cwd"), F.lit(1).cast("long").alias("imported_at"), F.lit(1).cast("long").alias("first_imported_at"),
        F.lit("create").alias("last_mode"), F.lit(0).cast("long").alias("source_message_count"), (F.col("updated_at") - F.when(conv % 4 == 1, 1).otherwise(0)).alias("source_updated_at"), F.array().cast("array<string>").alias("turn_digests"), F.lit(2).alias("digest_version"),
        F.lit(0).cast("long").alias("event_count"), F.lit(0).cast("long").alias("warning_count"), F.when(conv % 6 == 2, "source-shrank").alias("conflict_reason"), F.lit(None).cast("long").alias("conflict_turn"),
    )


_PENDING = f"WITH {_TALK}, p AS (SELECT session_id, conv_id, (conv_id * 1000 + max(turn0))::BIGINT AS updated_at, CASE WHEN conv_id % 4 = 0 THEN 'new' WHEN conv_id % 6 = 2 THEN 'blocked' WHEN conv_id % 4 = 1 THEN 'moved' WHEN conv_id % 9 = 0 THEN 'missing' ELSE 'done' END AS state FROM talk GROUP BY session_id, conv_id)"


def pending_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = talk_source(spark, sf_dir)[0]
    conv = F.substring("session_id", F.lit(2), F.length("session_id")).cast("long")
    return pending.pending(sessions, registry_of(spark, sf_dir), events.log_headers(sessions.where(conv % 9 != 0)))


@query(f"{_PENDING} SELECT session_id, updated_at, state FROM p")
def pending_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending_rows(spark, sf_dir).select("session_id", "updated_at", "state")


@query(f"{_PENDING} SELECT session_id, updated_at, state FROM p WHERE state IN ('new', 'moved', 'missing') ORDER BY updated_at DESC, session_id LIMIT 10")
def pending_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending.taken(pending_rows(spark, sf_dir), 10).select("session_id", "updated_at", "state")


@query(f"{_PENDING} SELECT state, count(*)::BIGINT AS n FROM p GROUP BY state")
def pending_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending_rows(spark, sf_dir).groupBy("state").agg(F.count("*").alias("n"))


@query(f"{_PENDING} SELECT session_id FROM p WHERE session_id LIKE '%7' ORDER BY session_id = '7' DESC, updated_at DESC, session_id LIMIT 1")
def id_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending.matching(talk_source(spark, sf_dir)[0], "7").select("session_id")


@query(f"WITH {_TALK}, s AS (SELECT DISTINCT session_id, conv_id FROM talk) SELECT session_id AS source_id, CASE WHEN conv_id % 4 = 0 THEN 5 WHEN conv_id % 3 = 0 THEN 5 ELSE 1 END::BIGINT AS imported_at, CASE WHEN conv_id % 4 = 0 THEN 5 ELSE 1 END::BIGINT AS first_imported_at FROM s WHERE conv_id % 4 <> 0 OR conv_id % 3 = 0")
def registry_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = registry_of(spark, sf_dir)
    conv = F.substring("session_id", F.lit(2), F.length("session_id")).cast("long")
    ids = talk_source(spark, sf_dir)[0].where(conv % 3 == 0).select(F.col("session_id").alias("source_id"))
    fixed = {"imported_at": F.lit(5).cast("long"), "first_imported_at": F.lit(5).cast("long"), "variant": F.lit("")}
    new = ids.select("source_id", *(fixed.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in old.schema if f.name != "source_id"))
    return merged_registry(old, new).select("source_id", "imported_at", "first_imported_at")


@query(
    f"""WITH {_TALK}, r AS (SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY msg_pos) - 1 AS position, text, turn0, conv_id FROM talk WHERE role = 'assistant'),
s AS (SELECT session_id, position, CASE WHEN conv_id % 7 = 0 AND turn0 = 4 THEN text || '.' ELSE text END AS text FROM r WHERE conv_id % 5 <> 0 OR turn0 <> 8),
s2 AS (SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY position) - 1 AS position, text FROM s),
j AS (SELECT coalesce(r.session_id, s2.session_id) AS session_id, coalesce(r.position, s2.position) AS position, r.text AS a, s2.text AS b FROM r FULL JOIN s2 ON r.session_id = s2.session_id AND r.position = s2.position),
g AS (SELECT session_id, count(a) AS sb, count(b) AS tb, coalesce(sum(length(b)), 0) AS chars, min(position) FILTER (a IS DISTINCT FROM b) AS mm FROM j GROUP BY session_id)
SELECT session_id, sb = tb AND mm IS NULL AS ok, sb::BIGINT AS source_blocks, tb::BIGINT AS stored_blocks, chars::BIGINT AS chars, CASE WHEN sb <> tb THEN -1 ELSE mm END::BIGINT AS mismatch_index, CASE WHEN sb <> tb THEN 'count-differs' WHEN mm IS NOT NULL THEN 'text-differs' END AS mismatch_reason FROM g"""
)
def fidelity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored reasoning lacks one block where conv_id % 5 = 0 and differs after its end where % 7 = 0."""
    _, _, parts = talk_source(spark, sf_dir)
    conv = F.substring("session_id", F.lit(2), F.length("session_id")).cast("long")
    changed = parts.where(~((conv % 5 == 0) & F.col("id").startswith("m8-"))).withColumn("text", F.when((conv % 7 == 0) & F.col("id").startswith("m4-"), F.concat("text", F.lit("."))).otherwise(F.col("text")))
    return fidelity.fidelity(fidelity.source_reasoning(parts), fidelity.source_reasoning(changed)).drop("source_head", "stored_head")


@query(
    f"""{_RECONCILE}, v AS (SELECT session_id, conv_id, turns, stored, answered FROM d)
SELECT session_id, CASE WHEN conv_id % 13 = 0 THEN false ELSE NOT (conv_id % 7 = 0 AND answered) AND stored = least(turns, 2) END AS ok, stored::BIGINT AS stored_turns, least(turns, 2)::BIGINT AS recorded_turns, (turns - least(turns, 2))::BIGINT AS drift, true AS prefix_intact FROM v"""
)
def verify_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of each plan's first two turns against the stored log of `stored_log`."""
    plan, _, stored, _ = stored_log(spark, sf_dir)
    planned = digests.turn_digests(digests.turn_slices(plan))
    known = planned.select("session_id", F.slice("turn_digests", 1, 2).alias("turn_digests"), F.lit(I.DIGEST_VERSION).alias("digest_version"))
    return fidelity.verified(known, digests.turn_digests(digests.turn_slices(stored)), planned).drop("legacy_record", "fidelity")


# --- validation ------------------------------------------------------------------------


def faulty_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of conversations with one kind of fault for each conv_id % 10."""
    log = talk_log(spark, sf_dir)[1].withColumn("conv_id", F.substring("session_id", F.lit(2), F.length("session_id")).cast("long"))
    fault = F.col("conv_id") % 10
    last = F.max("seq").over(Window.partitionBy("session_id"))
    log = log.withColumn("_last", last).where(~((fault == 1) & (F.col("seq") == F.col("_last"))))
    is_ = lambda n, t: (fault == n) & (F.col("type") == t)
    change = lambda c, *cases: F.coalesce(*[F.when(test, value) for test, value in cases], F.col(c))
    return (
        log.withColumn("type", F.when(is_(2, "step/end") & (F.col("turn") == 1), "note/odd").otherwise(F.col("type")))
        .withColumn("seq", change("seq", ((fault == 3) & (F.col("seq") >= 4), F.col("seq") + 1)))
        .withColumn("surface_op", F.when(is_(4, "user/message"), None).otherwise(F.col("surface_op")))
        .withColumn("reason_kind", F.when(is_(5, "turn/end"), None).otherwise(F.col("reason_kind")))
        .withColumn("role", change("role", (is_(6, "user/message"), F.lit("assistant"))))
        .withColumn("provider", F.when(is_(7, "assistant/message"), None).otherwise(F.col("provider")))
        .withColumn("turn", change("turn", (is_(8, "turn/start"), F.col("turn") + 1)))
        .withColumn("title", change("title", (is_(9, "session/title"), F.lit(""))))
        .drop("_last", "conv_id")
    )


@query(
    f"""WITH {_TALK_LOG}, l AS (SELECT log.*, substr(session_id, 2)::BIGINT % 10 AS fault, max(seq) OVER (PARTITION BY session_id) AS last FROM log),
o AS (SELECT *, last_value(CASE WHEN type = 'step/start' THEN true WHEN type = 'step/end' AND turn_no > 1 THEN false END IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS open FROM l WHERE fault = 2)
SELECT session_id, seq, 'V4' AS rule FROM l WHERE fault = 4 AND type = 'user/message' UNION ALL SELECT session_id, seq, 'V6' FROM l WHERE fault = 5 AND type = 'turn/end' UNION ALL SELECT session_id, seq, 'V9' FROM l WHERE fault = 6 AND type = 'user/message'
UNION ALL SELECT session_id, seq, 'V10' FROM l WHERE fault = 7 AND type = 'assistant/message' UNION ALL SELECT session_id, seq, 'V13' FROM l WHERE fault = 9 AND type = 'session/title' UNION ALL SELECT session_id, 5, 'V3' FROM l WHERE fault = 3 AND seq = 4
UNION ALL SELECT session_id, last - 1, 'V14' FROM l WHERE fault = 1 AND seq = last
UNION ALL SELECT session_id, seq, CASE type WHEN 'turn/start' THEN 'V5' WHEN 'turn/end' THEN 'V6' WHEN 'step/start' THEN 'V7' WHEN 'step/end' THEN 'V8' ELSE 'V10' END FROM l WHERE fault = 8 AND type IN ('turn/start', 'turn/end', 'step/start', 'step/end', 'assistant/message')
UNION ALL SELECT session_id, seq, CASE type WHEN 'step/end' THEN 'V2' WHEN 'step/start' THEN 'V7' ELSE 'V6' END FROM o WHERE type = 'step/end' AND turn_no = 1 OR open AND type IN ('step/start', 'turn/end')
UNION ALL SELECT session_id, seq, 'V14' FROM o WHERE seq = last AND open"""
)
def validate_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations in the whole faulty log, with what follows from broken brackets."""
    return validate.violations(faulty_log(spark, sf_dir))


@query(f"WITH {_ACTIVITY_LOG} SELECT session_id, count(*)::BIGINT AS events, 0::BIGINT AS broken FROM log GROUP BY session_id")
def validate_sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each session's events and violations, of which sound logs have none."""
    log = activity_log(spark, sf_dir)[1]
    broken = validate.violations(log).groupBy("session_id").agg(F.count("*").alias("n"))
    return log.groupBy("session_id").agg(F.count("*").alias("events")).join(broken, "session_id", "left").select("session_id", "events", F.coalesce("n", F.lit(0).cast("long")).alias("broken"))


@query(
    """WITH b AS (SELECT conv_id, turn, CASE WHEN conv_id % 5 = 1 AND turn % 3 = 2 THEN 'usage: object' WHEN conv_id % 5 = 2 AND turn >= 1 THEN 'cost: -Infinity' WHEN conv_id % 5 = 4 AND turn = 1 THEN 'usage: object' END AS offender FROM conversations)
SELECT conv_id, min(turn)::BIGINT AS seq, 'V15' AS rule, arg_min(offender, turn) AS offender FROM b WHERE offender IS NOT NULL GROUP BY conv_id"""
)
def lossless_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first lossy event of each conversation, stored as text: numbers too large stand deep in one member (conv_id % 5 = 1), as a member (2), in texts only (3) or in two members (4)."""
    kind, turn = F.col("conv_id") % 5, F.col("turn")
    deep = F.when((kind == 1) & (turn % 3 == 2), "1e999").when((kind == 4) & (turn == 1), "-12e0400").otherwise("1e308")
    cost = F.when((kind == 2) & (turn >= 1), "-1e400").when((kind == 4) & (turn == 1), "1e999").otherwise("0.5e-400")
    said = F.to_json(F.struct(F.when(kind == 3, F.concat(F.lit('"1e999", '), F.coalesce("text", F.lit("")))).otherwise(F.col("text")).alias("text"), "role"), {"ignoreNullFields": "false"})
    # members aren't in the order of their names: usage comes before cost
    data = F.concat(F.lit('{"usage":{"tokens":[1,{"n":'), deep, F.lit('}]},"cost":'), cost, F.lit(',"message":'), said, F.lit("}"))
    stored = _table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("seq"), F.concat(F.lit('{"type":"user/message","data":'), data, F.lit("}")).alias("data"))
    return validate.lossy(stored, session="conv_id")


@query(
    f"""WITH {_ACTIVITY_LOG} SELECT session_id, count(*) FILTER (type = 'turn/start')::BIGINT AS turns, count(*) FILTER (type = 'step/start')::BIGINT AS steps, count(*) FILTER (type = 'user/message')::BIGINT AS user_messages, count(*) FILTER (type = 'assistant/message')::BIGINT AS assistant_messages,
count(*) FILTER (type = 'tool/call')::BIGINT AS tool_calls, count(*) FILTER (type = 'tool/result')::BIGINT AS tool_results, count(*) FILTER (type IN ('user/message', 'assistant/message', 'tool/result'))::BIGINT AS surface_events FROM log GROUP BY session_id"""
)
def log_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.log_stats(activity_log(spark, sf_dir)[1])


# --- statistics and reports ----------------------------------------------------------------

_STATS = f"""WITH {_ACTIVITY}, t AS (SELECT session_id, count(DISTINCT turn) AS turns, count(*) FILTER (role = 'assistant') AS steps, count(*) FILTER (role = 'user') AS users, count(*) FILTER (type = 'view') AS texts,
  count(*) FILTER (type IN ('click', 'purchase', 'error')) AS tools, count(*) FILTER (type = 'error') AS errors, count(*) FILTER (type = 'purchase') AS open, count(*) FILTER (type = 'click' AND event_id % 2 <> 0) AS blank,
  count(*) FILTER (type IN ('click', 'purchase', 'error') AND event_id % 3 = 0) AS absent FROM seg GROUP BY session_id)"""


@query(
    f"""{_STATS} SELECT session_id, turns::BIGINT AS turns, steps::BIGINT AS steps, 0::BIGINT AS empty_steps, users::BIGINT AS user_messages, steps::BIGINT AS assistant_messages, (users + texts)::BIGINT AS text_blocks, tools::BIGINT AS tool_calls, errors::BIGINT AS tool_errors,
open::BIGINT AS tool_results_synthesized, blank::BIGINT AS empty_outputs, absent::BIGINT AS arguments_absent, (1 + 2 * turns + 3 * steps + users + 2 * tools)::BIGINT AS events FROM t"""
)
def plan_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned, log, _ = activity_log(spark, sf_dir)
    return events.plan_stats(planned, log).select("session_id", "turns", "steps", "empty_steps", "user_messages", "assistant_messages", "text_blocks", "tool_calls", "tool_errors", "tool_results_synthesized", "empty_outputs", "arguments_absent", "events")


@query(f"WITH {_TALK} SELECT session_id, count(*) FILTER (role = 'assistant')::BIGINT AS reasoning_blocks, coalesce(sum(length(text) + len(regexp_extract_all(text, '[\\x{{10000}}-\\x{{10FFFF}}]'))) FILTER (role = 'assistant'), 0)::BIGINT AS reasoning_chars, count(*) FILTER (role = 'user' AND turn0 = 1)::BIGINT AS injected_messages FROM talk GROUP BY session_id")
def reasoning_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned, log, _ = talk_log(spark, sf_dir)
    return events.plan_stats(planned, log).select("session_id", "reasoning_blocks", "reasoning_chars", "injected_messages")


@query(
    f"""{_STATS}, u AS (SELECT session_id, 'tool-result-synthesized' AS code, 'warning' AS severity, open AS n FROM t UNION ALL SELECT session_id, 'tool-output-empty', 'info', blank FROM t
  UNION ALL SELECT session_id, 'tool-arguments-not-json', 'warning', count(*) FROM act WHERE type IN ('click', 'purchase', 'error') AND (event_id % 3 = 2 OR event_id % 3 = 1 AND NOT json_valid(props)) GROUP BY session_id)
SELECT session_id, code, severity, n::VARCHAR AS n FROM u WHERE n > 0"""
)
def degradation_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned, log, _ = activity_log(spark, sf_dir)
    return W.degradations(events.plan_stats(planned, log)).select("session_id", "code", "severity", F.col("detail")["count"].alias("n"))


@query(f"WITH {_TALK}, s AS (SELECT DISTINCT conv_id FROM talk) SELECT 'title-missing' AS code, 'warning' AS severity, count(*)::BIGINT AS n FROM s WHERE conv_id % 10 = 0 HAVING count(*) > 0")
def warning_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = talk_source(spark, sf_dir)[0]
    return W.counts(W.rows_of(sessions.where("trim(title) = ''"), "title-missing"))


@query(
    f"""{_STATS} SELECT count(*)::BIGINT AS sessions, count(*) FILTER (steps % 3 = 0)::BIGINT AS imported, count(*) FILTER (steps % 3 = 1)::BIGINT AS appended, count(*) FILTER (steps % 3 = 2)::BIGINT AS conflicts,
sum(tools)::BIGINT AS tool_calls, sum(open)::BIGINT AS tool_results_synthesized, count(*) FILTER (steps % 3 < 2)::BIGINT AS fidelity_checked, count(*) FILTER (steps % 3 = 1)::BIGINT AS fidelity_ok, count(*) FILTER (open > 0)::BIGINT AS warnings, 0::BIGINT AS errors FROM t"""
)
def report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a made-up run whose status follows the sessions' steps."""
    planned, log, _ = activity_log(spark, sf_dir)
    third = F.col("steps") % 3
    stats = events.plan_stats(planned, log)
    results = stats.withColumn("status", F.when(third == 0, "imported").when(third == 1, "appended").otherwise("conflict")).withColumn("fidelity_ok", F.when(third < 2, third == 1))
    said = W.degradations(stats).where("code = 'tool-result-synthesized'")
    return report.totals(results, said).select("sessions", "imported", "appended", "conflicts", "tool_calls", "tool_results_synthesized", "fidelity_checked", "fidelity_ok", "warnings", "errors")


@query(f"WITH {_TALK} SELECT '/w/' || conv_id % 5 AS cwd, list_sort(list(DISTINCT session_id)) AS sessions FROM talk GROUP BY 1")
def workspaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .plans.engine import workspaces as grouped

    return grouped(talk_source(spark, sf_dir)[0])


@query(f"WITH {_TALK} SELECT DISTINCT '/w/' || conv_id % 5 AS cwd, session_id FROM talk")
def workspace_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of `workspaces`, one a session."""
    from .plans.engine import workspace_sessions as rows

    return rows(talk_source(spark, sf_dir)[0])


@query("SELECT event_id, '[attachment: ' || event_type || CASE WHEN event_id % 2 = 0 THEN ', ' || event_id || ' B' ELSE '' END || ']' || CASE WHEN event_id % 3 = 0 THEN ' file:' || event_id ELSE '' END || ' (content not migrated)' AS text FROM events")
def file_placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    id_ = F.col("event_id")
    text = events.file_placeholder(F.col("event_type"), F.when(id_ % 2 == 0, id_), F.when(id_ % 3 == 0, F.concat(F.lit("file:"), id_.cast("string"))))
    return _table(spark, sf_dir, "events").select("event_id", text.alias("text"))


@query("SELECT conv_id, turn, (length(text) + len(regexp_extract_all(text, '[\\x{10000}-\\x{10FFFF}]')))::BIGINT AS utf16 FROM conversations")
def utf16_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UTF-16 lengths of all texts: characters above U+FFFF count twice."""
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", I.utf16_length(F.col("text")).alias("utf16"))
