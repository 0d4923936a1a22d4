"""Settings of a run, and the session that it runs in."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields
from pathlib import Path

from pyspark.sql import SparkSession

_TRUE, _FALSE = (True, "true", "1", 1), (False, "false", "0", 0)


def as_bool(value: object, default: bool) -> bool:
    """true/'true'/'1'/1 and false/'false'/'0'/0; anything else is the default."""
    return True if value in _TRUE else False if value in _FALSE else default


def as_path(value: object, variable: str, default: str) -> str:
    """The first of value, the environment's variable and default that is there, with ~ expanded."""
    for candidate in (value, os.environ.get(variable)):
        if isinstance(candidate, str) and candidate.strip():
            return str(Path(candidate).expanduser())
    return str(Path(default).expanduser())


@dataclass(frozen=True)
class Config:
    """Every field has a default; `normalized` never fails on odd input."""

    source_home: str = "~/.turnloom/source"
    store: str = "~/.turnloom/store"
    source_mode: str = "auto"
    include_legacy: bool = False
    auto_import: str = "off"
    max_sessions: int = 0
    format_version: int = 0
    dry_run: bool = False

    @classmethod
    def normalized(cls, raw: dict | None = None) -> Config:
        raw = raw or {}
        most = raw.get("max_sessions", 0)
        whole = isinstance(most, (int, float)) and not isinstance(most, bool) and most == most and most not in (float("inf"), float("-inf"))
        return cls(
            source_home=as_path(raw.get("source_home"), "TURNLOOM_SOURCE", cls.source_home),
            store=as_path(raw.get("store"), "TURNLOOM_STORE", cls.store),
            source_mode=raw.get("source_mode") if raw.get("source_mode") in ("auto", "db", "rollout") else "auto",
            include_legacy=as_bool(raw.get("include_legacy"), False),
            auto_import="pending" if raw.get("auto_import") == "pending" else "off",
            max_sessions=max(0, int(most)) if whole else 0,
            format_version=3 if raw.get("format_version") in (3, "3") else 0,
            dry_run=as_bool(raw.get("dry_run"), False),
        )

    def as_dict(self) -> dict:
        return {f.name: getattr(self, f.name) for f in fields(self)}


#: What the engine asks of a session: UTC, the last of an object's repeated keys as in JavaScript, and joins by (session, position) that use a deal by session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def session(master: str | None = None, **more: str) -> SparkSession:
    builder = SparkSession.builder.appName("turnloom").config(map=SETTINGS | more)
    return (builder.master(master) if master else builder).getOrCreate()
