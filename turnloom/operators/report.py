"""A run's result as totals, status counts and text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATUSES = ("imported", "appended", "skipped", "conflict", "failed")


def totals(results: DataFrame, warnings: DataFrame) -> DataFrame:
    """One row: sessions by status, sums of the plans' counters, fidelity and warnings."""
    status = lambda s: F.count_if(F.col("status") == s)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    rows = results.agg(
        F.count("*").alias("sessions"),
        *(status(s).alias({"conflict": "conflicts"}.get(s, s)) for s in STATUSES),
        *(total(c) for c in ("events", "reasoning_blocks", "reasoning_chars", "empty_reasoning", "tool_calls", "tool_results_synthesized", "file_placeholders")),
        F.count("fidelity_ok").alias("fidelity_checked"),
        F.count_if("fidelity_ok").alias("fidelity_ok"),
    )
    counted = warnings.agg(F.count("*").alias("warnings"), F.count_if(F.col("severity") == "error").alias("errors"))
    return rows.crossJoin(counted)


def by_status(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count("*").alias("n")).orderBy("status")


def markdown(total: dict, statuses: Iterable[dict], counts: list[dict], warnings: Iterable[dict], stamp: str) -> Iterator[str]:
    """The report's lines from the totals row, every session's row, the warnings' counts and every warning."""
    yield from (f"# Import report {stamp}", "", "| figure | value |", "| --- | ---: |", *(f"| {k} | {v:,} |" for k, v in total.items()))
    yield from ("", "| session | status | reason |", "| --- | --- | --- |")
    for r in statuses:
        yield f"| {r['session_id']} | {r['status']} | {r.get('reason') or ''} |"
    if counts:
        yield from ("", "| warning | severity | count |", "| --- | --- | ---: |", *(f"| {w['code']} | {w['severity']} | {w['n']:,} |" for w in counts))
        yield from ("", "| session | warning | severity | where | detail |", "| --- | --- | --- | --- | --- |")
        for w in warnings:
            yield f"| {w['session_id']} | {w['code']} | {w['severity']} | {w['where'] or ''} | {', '.join(f'{k}: {v}' for k, v in (w['detail'] or {}).items())} |"
