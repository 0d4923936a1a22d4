"""A whole run over all sessions in one job: read, plan, validate, reconcile, write, read back, record.

A session's faults are columns of its row, so one bad session does not stop the others.
"""

from __future__ import annotations

import json
import shutil
import time
from collections.abc import Callable
from pathlib import Path
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..config import Config
from ..functions.ids import by_locale
from ..operators import chain, digests, events, fidelity, reconcile, report, scan, validate
from ..operators import pending as P
from ..operators import warnings as W
from ..sinks.lock import import_lock
from ..sinks.store import EVENT_COLUMNS, ParquetSink, Registry, Sink, cut, merged_registry, records
from ..sources.resolve import Source, open_source


#: Logs that couldn't be read whole: the events that their heads tell of, and those found.
FAULTS = "session_id string, expected bigint, found bigint"
#: Messages of a session that one task can still take.
LONG_SESSION = 1_000_000


class Plan(NamedTuple):
    planned: DataFrame
    events: DataFrame
    headers: DataFrame
    stats: DataFrame
    violations: DataFrame
    warnings: DataFrame
    segments: int | None = None


def only(source: Source, ids: DataFrame) -> Source:
    """The source's rows of these sessions; ids are filtered first, so the big tables are read for them only."""
    keep = lambda df: df.join(ids.select("session_id"), "session_id", "left_semi")
    return source._replace(sessions=keep(source.sessions), messages=keep(source.messages), parts=keep(source.parts), warnings=keep(source.warnings))


def plan(source: Source, format_version: int = 0, variant: str = "") -> Plan:
    """The source's sessions as event logs, with what is to be said about them."""
    # only where a session is too long for a task are sessions cut into segments, which takes more shuffles
    segments = scan.SEGMENT_ROWS if scan.longest(source.messages, "session_id") > LONG_SESSION else None
    planned = cut(events.planned_messages(source.sessions, source.messages, source.parts, segment_rows=segments))
    log = cut(events.event_log(planned, source.sessions, format_version))
    stats = cut(events.plan_stats(planned, log))
    return Plan(planned, log, events.log_headers(source.sessions, format_version, variant), stats, validate.violations(log, segment_rows=segments), source.warnings.unionByName(W.plan_warnings(source.sessions, planned, stats)), segments)


class Run(NamedTuple):
    """results: one row a session (status imported, appended, skipped, conflict or failed); totals and warnings of the run."""

    results: DataFrame
    totals: DataFrame
    warnings: DataFrame


def run_import(spark: SparkSession, config: Config, sink: Sink, source: Source | None = None, registry: Registry | None = None, wanted: DataFrame | None = None, live: DataFrame | None = None, force_variant: str = "", now: int | None = None) -> Run:
    """Imports the wanted (else all) sessions that aren't live.

    A force_variant writes separate logs under ids of their own, whatever is
    stored, and clears a recorded conflict.
    """
    now = int(time.time() * 1000) if now is None else now
    source = source or open_source(spark, config)
    if wanted is not None:
        source = only(source, wanted)
    waiting = None
    if live is not None:
        waiting = W.rows_of(source.sessions.join(live.select("session_id"), "session_id", "left_semi"), "session-live")
        ids = source.sessions.join(live.select("session_id"), "session_id", "left_anti").select("session_id")
        source = only(source, ids)
    made = plan(source, config.format_version, force_variant)
    log = made.events
    counts = source.messages.groupBy("session_id").agg(F.count("*").alias("message_count"))
    invalid = cut(made.violations.select("session_id").distinct())
    blank = source.sessions.join(counts, "session_id", "left_anti").select("session_id")
    sound = made.headers.join(invalid, "session_id", "left_anti").join(blank, "session_id", "left_anti")
    # of the store, only what the run is about is read
    ids = None if wanted is None else cut(source.sessions.select("session_id").distinct())
    stored_headers, stored_heads = sink.headers(ids), sink.heads(ids)
    if force_variant:
        stored_headers, stored_heads = stored_headers.limit(0), stored_heads.limit(0)
    # heads decide; a log is read only where its plan differs from it
    decided = cut(chain.decisions(log, sound, stored_heads, stored_headers, lambda some: sink.readable(some)[0], segment_rows=made.segments))
    touched = cut(decided.where(F.col("mode").isin("create", "append")).select("session_id"))
    moved = not touched.isEmpty()
    if not config.dry_run and moved:
        written = reconcile.increments(log, decided).select(EVENT_COLUMNS)
        fresh = decided.where("mode = 'create'").select("session_id")
        # a variant's log stands under its own id
        rename = (lambda df: df.join(sound.select("session_id", "target_id"), "session_id").withColumn("session_id", F.col("target_id")).drop("target_id")) if force_variant else (lambda df: df)
        headers = sound.join(fresh, "session_id", "left_semi").select(*(c.split()[0] for c in schema.HEADERS.split(", ")))
        if force_variant:
            headers = headers.withColumn("session_id", F.col("target_id"))
        sink.append(rename(written), headers, rename(chain.written_heads(log, decided, segment_rows=made.segments)))
    # what was written is read back and compared; the rest has not changed. A log that can't be read whole fails its session alone
    asked = cut(decided.where(F.col("mode").isin("create", "append") | (F.col("reason") == "turn-content-rewritten")).select("session_id"))
    there = sound.join(asked, "session_id", "left_semi")
    if asked.isEmpty():
        read_back, faults = log.limit(0), None
    else:
        read_back, faults = sink.readable(there.select(F.col("target_id" if force_variant else "session_id").alias("session_id")))
    faults = spark.createDataFrame([], FAULTS) if faults is None or force_variant else cut(faults)
    if force_variant:
        read_back = read_back.join(sound.select(F.col("target_id").alias("session_id"), F.col("session_id").alias("_s")), "session_id").withColumn("session_id", F.col("_s")).drop("_s")
    answers = source.messages.where("role = 'assistant'").select("session_id", "msg_pos").join(touched, "session_id", "left_semi")
    checked = fidelity.fidelity(fidelity.source_reasoning(source.parts.join(answers, ["session_id", "msg_pos"], "left_semi")), fidelity.stored_reasoning(read_back))
    status = F.when(F.col("_invalid") | F.col("_fault"), "failed").when(F.col("_blank"), "skipped").otherwise(F.element_at(F.create_map(*(F.lit(x) for x in ("create", "imported", "append", "appended", "skip", "skipped", "conflict", "conflict"))), F.col("mode")))
    flag = lambda df, name: df.withColumn(name, F.lit(True))
    results = cut(
        source.sessions.select("session_id", "title")
        .join(flag(invalid, "_invalid"), "session_id", "left")
        .join(flag(blank, "_blank"), "session_id", "left")
        .join(flag(faults.select("session_id"), "_fault"), "session_id", "left")
        .join(decided.drop("planned_events"), "session_id", "left")
        .join(made.stats, "session_id", "left")
        .join(checked.select("session_id", F.col("ok").alias("_ok")), "session_id", "left")
        .withColumns({"_invalid": F.coalesce("_invalid", F.lit(False)), "_blank": F.coalesce("_blank", F.lit(False)), "_fault": F.coalesce("_fault", F.lit(False))})
        .withColumn("status", status)
        .withColumn("fidelity_ok", F.when(F.col("status").isin("imported", "appended"), F.coalesce("_ok", F.lit(True))) if not config.dry_run else F.lit(None).cast("boolean"))
        .withColumn("reason", F.when(F.col("_invalid"), "event-log-invalid").when(F.col("_fault"), "persistence-inspect-failed").when(F.col("_blank"), "source-session-empty").otherwise(F.col("reason")))
        .drop("_invalid", "_blank", "_fault", "_ok")
    )
    said = made.warnings.unionByName(W.rows_of(invalid, "event-log-invalid", "error")).unionByName(W.rows_of(blank, "source-session-empty")).unionByName(W.rows_of(decided.where("mode = 'conflict'"), "conflict", "error", F.create_map(F.lit("reason"), F.col("reason")))).unionByName(W.rows_of(results.where("not fidelity_ok"), "fidelity-mismatch", "error"))
    said = said.unionByName(W.rows_of(faults, "persistence-inspect-failed", "error", F.create_map(F.lit("expected"), F.col("expected").cast("string"), F.lit("found"), F.col("found").cast("string"))))
    said = said if waiting is None else said.unionByName(waiting)
    if registry is not None and (problem := registry.unreadable()):
        said = said.unionByName(spark.createDataFrame([(None, "registry-unreadable", "warning", registry.root, {"message": problem})], schema.WARNINGS))
    if registry is not None and not config.dry_run:
        slices = digests.turn_digests(digests.turn_slices(log))
        more = counts.join(log.groupBy("session_id").agg(F.count("*").alias("event_count")), "session_id", "left").join(said.groupBy("session_id").agg(F.count("*").alias("warning_count")), "session_id", "left").withColumn("warning_count", F.coalesce("warning_count", F.lit(0).cast("long")))
        new = records(decided, slices, made.headers, source.sessions, more, now, force_variant)
        if force_variant:
            canonical = registry.load().where("variant = ''").join(decided.select(F.col("session_id").alias("source_id")), "source_id", "left_semi").withColumn("conflict_reason", F.lit(None).cast("string")).withColumn("conflict_turn", F.lit(None).cast("long"))
            new = new.unionByName(canonical.select(new.columns))
        registry.save(merged_registry(registry.load(), new.select(registry.load().columns)))
    return Run(results, report.totals(results, said), said)


def named(sessions: DataFrame, ids: list[str]) -> DataFrame:
    """The sessions that ids name, by whole ids or their ends; an id that names none is an error."""
    found = {i: P.matching(sessions, i).select("session_id").first() for i in ids}
    if missing := [i for i, row in found.items() if row is None]:
        raise LookupError(f"no such session: {', '.join(missing)}")
    return sessions.sparkSession.createDataFrame(list(found.values()), "session_id string").distinct()


def sync(spark: SparkSession, config: Config, force: bool = False, ids: list[str] | None = None) -> Run:
    """Imports the sessions that ids name, else what is pending, holding the lock from before the pending set is made."""
    with import_lock(f"{config.store}/import.lock", spark=spark) as lease:
        sink, registry = ParquetSink(spark, config.store, config.format_version, lease.check), Registry(spark, config.store)
        source = open_source(spark, config)
        wanted = named(source.sessions, ids) if ids else P.taken(P.pending(source.sessions, registry.load(), sink.headers(), force), config.max_sessions)
        return run_import(spark, config, sink, source, registry, wanted, force_variant=f"forced-{int(time.time() * 1000)}" if force else "")


def status(spark: SparkSession, config: Config) -> DataFrame:
    """(state, n): the source's sessions by pending state."""
    source = open_source(spark, config)
    return P.pending(source.sessions, Registry(spark, config.store).load(), ParquetSink(spark, config.store).headers()).groupBy("state").agg(F.count("*").alias("n")).orderBy("state")


def imported(spark: SparkSession, config: Config) -> DataFrame:
    """The registry's records, latest import first."""
    known = Registry(spark, config.store).load()
    return known.select("source_id", "target_id", "variant", "title", "imported_at", "last_mode", "source_message_count", "event_count", "warning_count", "conflict_reason").orderBy(F.desc("imported_at"), by_locale("source_id"), "source_id", "variant")


def paths(config: Config) -> dict[str, str]:
    """Where the registry and the latest report are."""
    return {"registry": f"{config.store}/registry", "report": f"{config.store}/reports/latest.md"}


def verify(spark: SparkSession, config: Config, ids: list[str] | None = None) -> DataFrame:
    """One row a record: its log against the record, the plan and the source's reasoning."""
    sink, source = ParquetSink(spark, config.store, config.format_version), open_source(spark, config)
    known = Registry(spark, config.store).load().where("variant = ''")
    if ids:
        known = known.where(F.col("source_id").isin(ids) | F.col("target_id").isin(ids))
    known = known.withColumnRenamed("source_id", "session_id")
    source = only(source, known)
    made = plan(source, config.format_version)
    readable, faults = sink.readable(known if ids else None)
    stored = readable.join(known, "session_id", "left_semi").join(faults, "session_id", "left_anti")
    of = lambda df: digests.turn_digests(digests.turn_slices(df))
    checked = fidelity.fidelity(fidelity.source_reasoning(source.parts), fidelity.stored_reasoning(stored))
    return fidelity.verified(known, of(stored), of(made.events), checked)


def audit(spark: SparkSession, config: Config) -> DataFrame:
    """One row of corpus totals from planning every session and comparing its reasoning; nothing is written."""
    source = open_source(spark, config)
    made = plan(source, config.format_version)
    log = made.events
    checked = fidelity.fidelity(fidelity.source_reasoning(source.parts), fidelity.stored_reasoning(log))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    sums = made.stats.agg(F.count("*").alias("sessions"), *(total(c) for c in ("turns", "steps", "events", "reasoning_blocks", "reasoning_chars", "tool_calls", "file_placeholders")))
    wrong = checked.agg(F.count_if(~F.col("ok")).alias("fidelity_wrong"))
    broken = made.violations.agg(F.count_distinct("session_id").alias("invalid"))
    said = made.warnings.agg(F.count("*").alias("warnings"))
    return sums.crossJoin(wrong).crossJoin(broken).crossJoin(said)


def workspaces(sessions: DataFrame) -> DataFrame:
    """(cwd, sessions): the sessions of each working folder; those without one are left out."""
    return sessions.where("directory <> ''").groupBy(F.col("directory").alias("cwd")).agg(F.array_sort(F.collect_set("session_id")).alias("sessions"))


def workspace_sessions(sessions: DataFrame) -> DataFrame:
    """(cwd, session_id): the same as rows, so that no folder has to fit in one."""
    return sessions.where("directory <> ''").select(F.col("directory").alias("cwd"), "session_id").distinct()


def mount(groups: DataFrame, attach: Callable[[str, str], str]) -> list[tuple[str, str, str]]:
    """Attaches every session to its folder's workspace by a callback that says attached, already, skipped or failed."""
    return [(r.cwd, s, attach(r.cwd, s)) for r in groups.toLocalIterator() for s in r.sessions]


def write_report(run: Run, folder: str, stamp: str) -> None:
    """<stamp>.json and .md with every session and warning, a partition at a time, and the same as latest."""
    out = Path(folder)
    out.mkdir(parents=True, exist_ok=True)
    total = run.totals.first().asDict()
    sessions = cut(run.results.select("session_id", "status", "reason").orderBy("status", "session_id"))
    said = cut(run.warnings.select("session_id", "code", "severity", "where", "detail").orderBy("session_id", "code"))
    counts = [r.asDict() for r in W.counts(said).collect()]
    rows = lambda df: (r.asDict(recursive=True) for r in df.toLocalIterator())
    show = lambda x: json.dumps(x, ensure_ascii=False)
    with (out / f"{stamp}.json").open("w", encoding="utf-8") as to:
        to.write(f'{{"stamp": {show(stamp)},\n"totals": {show(total)},\n"warnings": {show(counts)}')
        for name, df in (("sessions", sessions), ("warning_details", said)):
            to.write(f',\n"{name}": [')
            for i, row in enumerate(rows(df)):
                to.write(f"{',' if i else ''}\n {show(row)}")
            to.write("]")
        to.write("}\n")
    with (out / f"{stamp}.md").open("w", encoding="utf-8") as to:
        to.writelines(f"{line}\n" for line in report.markdown(total, rows(sessions), counts, rows(said), stamp))
    for kind in ("json", "md"):
        shutil.copyfile(out / f"{stamp}.{kind}", out / f"latest.{kind}")
