"""Choosing a source: the SQLite store, else transcripts, and legacy files if asked for."""

from __future__ import annotations

from pathlib import Path
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from .. import schema
from ..config import Config
from ..operators import normalize as N
from ..operators.warnings import invalid_json
from . import legacy, rollout, sqlite

DATABASE, ROLLOUT, LEGACY = "cli/store.db", "cli/rollout", "projects"


class Source(NamedTuple):
    kind: str
    sessions: DataFrame
    messages: DataFrame
    parts: DataFrame
    warnings: DataFrame
    reason: str | None = None


def presence(config: Config) -> dict[str, int | None]:
    """Bytes of the store, and files of the other sources; None for what isn't there."""
    home = Path(config.source_home)
    store = home / DATABASE
    count = lambda p, g: sum(1 for _ in p.rglob(g)) if p.is_dir() else None
    return {"db": store.stat().st_size if store.is_file() else None, "rollout": count(home / ROLLOUT, rollout.FILES), "legacy": count(home / LEGACY, legacy.FILES)}


def empty(spark: SparkSession, kind: str, reason: str | None) -> Source:
    made = lambda s: spark.createDataFrame([], s)
    return Source(kind, made(schema.SESSIONS), made(schema.MESSAGES), made(schema.PARTS), made(schema.WARNINGS), reason)


#: What is said of a store that can't be read.
FAULTS = {"database-open-failed": "db-open-failed", "schema-unreadable": "db-schema-unreadable"}


def _said(spark: SparkSession, *rows: tuple[str, str, str, str | None]) -> DataFrame:
    """Warnings about the source as a whole: (code, severity, where, reason)."""
    return spark.createDataFrame([(None, code, severity, where, None if reason is None else {"reason": reason}) for code, severity, where, reason in rows], schema.WARNINGS)


def from_tables(session: DataFrame, message: DataFrame, part: DataFrame) -> Source:
    """A source from stored session, message and part tables."""
    messages = N.normalized_messages(message)
    parts = N.normalized_parts(part, messages)
    sessions = N.with_session_model(N.normalized_sessions(session), messages)
    return Source("sqlite", sessions, messages, parts, invalid_json(messages, parts))


def open_source(spark: SparkSession, config: Config) -> Source:
    """The configured source; reason tells why the store wasn't used.

    Mode db never falls back; auto falls back to transcripts whatever is wrong
    with the store. Legacy sessions are added if the settings say so.
    """
    home = Path(config.source_home)
    store = str(home / DATABASE)
    reason = sqlite.probe(store) if config.source_mode != "rollout" else None
    found = None
    said = [(FAULTS[reason], "error", store, reason)] if reason in FAULTS else []
    if config.source_mode != "rollout" and reason is None:
        found = from_tables(*sqlite.store_tables(spark, store))
    elif config.source_mode != "db" and (home / ROLLOUT).is_dir() and any((home / ROLLOUT).glob(rollout.FILES)):
        found = Source("rollout", *rollout.read(spark, str(home / ROLLOUT)), reason)
        said += [("source-rollout-fallback", "warning", store, reason)] if reason else []
    if found is None:
        found = empty(spark, "none", reason or "rollout-dir-missing")
        said += [("rollout-dir-missing", "warning", str(home / ROLLOUT), reason)] if config.source_mode != "db" else []
    if config.include_legacy and not (home / LEGACY).is_dir():
        said.append(("legacy-dir-missing", "warning", str(home / LEGACY), None))
    if said:
        found = found._replace(warnings=found.warnings.unionByName(_said(spark, *said)))
    if config.include_legacy and (home / LEGACY).is_dir() and any((home / LEGACY).rglob(legacy.FILES)):
        old = legacy.read(spark, str(home / LEGACY))
        found = Source(found.kind, *(a.unionByName(b, allowMissingColumns=True) for a, b in zip(found[1:5], old, strict=True)), found.reason)
    return found
