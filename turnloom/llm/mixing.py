"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order that reruns
repeat; the queue is gone through once for each allowed repeat. A copy's
virtual finish time is the source's cumulative words up to its end, divided by
the source's target. All copies are range-sorted by that time and the order is
cut where the total budget is spent. A copy that reaches over its source's
target is queued in two pieces, so that this cut gives every source its target.

Cumulative sums run within ranges of the sort key and add the sums of the
ranges before, so no source and no sort has to fit in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, in_order, sums_before, word_count

#: Documents, about, in one range of a queue, and ranges at most: their sums are added up in one task.
RANGE_ROWS, MOST_RANGES = 2_000, 100_000


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, repeats: int = 2) -> DataFrame:
    """(source, source_size, target) of every source of sizes(source, size).

    Sources by code point, null last, take the weights in turn. Together they get
    share times all sizes, but none more than repeats times its own size; what
    is over goes to the others by weight. So a target is the smaller of its cap
    and weight times one common level, which is found by filling the sources in
    the order of cap / weight. One row for each source is ordered here.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    rows = total.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn + 1).cast("int")))
    rows = rows.withColumn("cap", (F.col("source_size") * repeats).cast("double")).withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    everyone = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = (
        rows.withColumn("budget", F.sum("source_size").over(everyone) * F.lit(float(share)))
        .withColumn("filled", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("own", (F.col("budget") - F.col("filled")) / F.col("open"))
        # the level is that of the first source whose cap is not reached, which is the largest of such; without one, all are full
        .withColumn("level", F.max(F.when(F.col("own") < F.col("ratio"), F.col("own"))).over(everyone))
    )
    return rows.select("source", "source_size", F.least("cap", F.coalesce(F.col("weight") * F.col("level"), F.col("cap"))).alias("target"))


def mix_sources(
    documents: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    repeats: int = 2,
    seed: int = 0,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    key_column: str | None = None,
) -> DataFrame:
    """The mix: key, doc_id, source, size, source_size, target, copy, piece, words, finish, position, taken.

    A row for each document, copy (0 .. repeats - 1) and piece. A copy in which its source reaches
    its target is queued in two pieces, so that the cut can fall there; others are one piece. finish
    is a piece's virtual finish time, position the number of words before it in the
    order by finish, and taken the words of it before the total budget is spent, which
    is the sum of the rounded-down targets. So a source's taken words are its target, rounded down. A
    document without words has one piece a copy, with finish 0 and taken 0. The null source is a source of its own.
    key tells rows apart: it is key_column, whose values must differ, or made here. Rows that repeat an id,
    or have a null one, are documents of their own; ties in the shuffle go by id, then size.
    """
    key = F.monotonically_increasing_id() if key_column is None else F.col(key_column)
    id_ = F.col(id_column)
    shuffle = F.md5(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(f"/{seed}")))
    rows = cut(documents.select(key.alias("key"), id_.alias("doc_id"), F.col(source_column).alias("source"), word_count(F.col(text_column)).alias("size"), shuffle.alias("shuffle")))
    ranges = min(MOST_RANGES, max(1, -(-rows.count() // RANGE_ROWS)))
    targets = cut(source_targets(rows, weights, share, repeats))
    # the shuffle key is a hash, so equal parts of its values are ranges of even size
    queues = rows.withColumn("part", F.floor(F.conv(F.substring("shuffle", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32)) * ranges).cast("int"))
    queues = sums_before(queues, ["source", "part"], [F.col("shuffle"), F.col("doc_id"), F.col("size"), F.col("key")], "size", "before")
    known = targets.withColumnRenamed("source", "_source")
    queues = queues.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "part")
    copies = queues.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).withColumn("start", F.col("before") + F.col("copy") * F.col("source_size"))
    early = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.floor("target").cast("long") - F.col("start")))
    both = F.array(F.struct(F.lit(0).alias("piece"), early.alias("words"), (F.col("start") + early).alias("end")), F.struct(F.lit(1).alias("piece"), (F.col("size") - early).alias("words"), (F.col("start") + F.col("size")).alias("end")))
    pieces = copies.withColumn("_", F.explode(F.filter(both, lambda x: (x["words"] > 0) | ((F.col("size") == 0) & (x["piece"] == 0))))).select("*", "_.*").drop("_")
    pieces = pieces.withColumn("finish", F.when((F.col("target") > 0) & (F.col("size") > 0), F.col("end") / F.col("target")).otherwise(F.lit(0.0)))
    # ranges by sampled quantiles of the order, so that a source of little weight, whose times are late, is spread too
    placed = in_order(pieces, [F.col(c) for c in ("finish", "piece", "shuffle", "doc_id", "copy", "size", "key")], "mix-order")
    placed = sums_before(placed, ["part"], [F.col("at")], "words", "position")
    budget = targets.agg(F.coalesce(F.sum(F.floor("target").cast("long")), F.lit(0)).alias("n")).first().n
    taken = F.greatest(F.lit(0).cast("long"), F.least(F.col("words"), F.lit(budget) - F.col("position")))
    return placed.withColumn("taken", taken).select("key", "doc_id", "source", "size", "source_size", "target", "copy", "piece", "words", "finish", "position", "taken")
