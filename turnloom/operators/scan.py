"""Running values over sessions of any length, cut into segments.

A window partitioned by session puts an endless session into one task. Here a
session is cut into segments of its positions; windows run inside segments, each
segment is reduced to what it carries on (a sum, the last value), these
few rows are combined along the session, and what comes before a segment is joined
to its rows. Both sides of that join are dealt by session and segment, so the rows are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoint import cut

#: Rows of a segment, about; a session with more is spread over tasks.
SEGMENT_ROWS = 100_000

#: Rows of messages or events that a task is dealt, about.
TASK_ROWS = 50_000

Order = str | list[str]


def _names(order: Order) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def longest(df: DataFrame, *keys: str) -> int:
    """Rows of the largest group."""
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def tasks(df: DataFrame, rows: int, each: int = TASK_ROWS) -> int:
    """How many tasks so many rows are dealt over: as the session says, or more, so that a task's share doesn't grow with the rows."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // each))


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df repartitioned by keys, for tables of about so many rows."""
    n = tasks(df, rows)
    return df.repartition(*keys) if n == tasks(df, 0) else df.repartition(n, *keys)


def segment_of(position: str, rows: int = SEGMENT_ROWS) -> Column:
    return F.floor(F.col(position) / rows)


def running(df: DataFrame, keys: list[str], segment: Column, order: Order, sums: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None) -> DataFrame:
    """df plus, for each row, sums and last values (nulls passed over) of the rows before it, within keys and along order.

    segment must grow along the order. A sum of nothing is 0, a last value of nothing null.
    """
    sums, lasts, order = sums or {}, lasts or {}, _names(order)
    own = df.withColumns({"_segment": segment, **{f"_in_{n}": c for n, c in (sums | lasts).items()}})
    inside = Window.partitionBy(*keys, "_segment").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    place = F.struct(*order)
    total = own.groupBy(*keys, "_segment").agg(
        *(F.coalesce(F.sum(f"_in_{n}"), F.lit(0)).alias(f"_of_{n}") for n in sums), *(F.max_by(f"_in_{n}", F.when(F.col(f"_in_{n}").isNotNull(), place)).alias(f"_of_{n}") for n in lasts)
    )
    prior = Window.partitionBy(*keys).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    carry = total.select(
        *(F.col(k).alias(f"_key_{k}") for k in keys), F.col("_segment").alias("_key_segment"), *(F.coalesce(F.sum(f"_of_{n}").over(prior), F.lit(0)).alias(f"_to_{n}") for n in sums), *(F.last(f"_of_{n}", ignorenulls=True).over(prior).alias(f"_to_{n}") for n in lasts)
    )
    here = own.withColumns({f"_at_{n}": F.sum(f"_in_{n}").over(inside) for n in sums} | {f"_at_{n}": F.last(f"_in_{n}", ignorenulls=True).over(inside) for n in lasts})
    match = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys] + [F.col("_segment") == F.col("_key_segment")]
    both = here.join(carry, match)
    made = {n: F.col(f"_to_{n}") + F.coalesce(f"_at_{n}", F.lit(0)) for n in sums} | {n: F.coalesce(f"_at_{n}", f"_to_{n}") for n in lasts}
    return both.withColumns(made).select(*df.columns, *(n for n in made if n not in df.columns))


def numbered(df: DataFrame, keys: list[str], order: Order, name: str, rows: int = SEGMENT_ROWS) -> DataFrame:
    """df plus each row's number, from 0, within keys and along order; ties must not matter.

    Rows are sorted by ranges and checkpointed, so a range's number and a row's place in it are fixed.
    """
    order = _names(order)
    # checkpointed first too, as sampling the ranges would make the rows again
    df = cut(df)
    n = df.count()
    # ranges of more rows, if those asked for would make more tasks than the rows need
    ranges = max(1, min(-(-n // rows), tasks(df, n)))
    at = F.monotonically_increasing_id()
    placed = cut(df.repartitionByRange(ranges, *keys, *order).sortWithinPartitions(*keys, *order).withColumn("_at", at))
    return running(placed, keys, F.shiftrightunsigned("_at", 33), "_at", sums={name: F.lit(1).cast("long")}).drop("_at")
