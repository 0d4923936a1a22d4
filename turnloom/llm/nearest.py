"""Approximate nearest neighbours by cross-polytope hashing with multiprobe.

A fast Hadamard pseudo-rotation (three rounds of random signs and a Hadamard
transform) turns each unit vector; its hash is the nearest signed axis. Every
table has its own rotations. As the vectors grow in number, further hashes are
joined to the first, so that a table's buckets grow with their square root. A query looks into
the buckets that are nearest to it over all hashes of a table, and the vectors
found there are ranked by their exact distance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, written

#: Vectors, and queries, of a bucket that are compared in one block.
BLOCK = 4096


def rotations(dim: int, tables: int, hashes: int, seed: int) -> np.ndarray:
    """Random signs, (tables, hashes, 3, padded dimension)."""
    size = 1 << max(0, math.ceil(math.log2(dim)))
    return np.random.default_rng([seed, dim]).choice(np.array([-1.0, 1.0]), (tables, hashes, 3, size))


def rotated(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Rows of x (padded) after three rounds of signs and a Hadamard transform."""
    n, size = x.shape
    for s in signs:
        x = x * s
        half = 1
        while half < size:
            x = x.reshape(n, size // (2 * half), 2, half)
            x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(n, size)
            half *= 2
        x = x / math.sqrt(size)
    return x


def hash_sides(size: int, count: int) -> list[int]:
    """How many signed axes each of a table's hashes has, for count vectors.

    The first has all 2 * size; the others, powers of two, bring the
    buckets to about 2 * sqrt(count).
    """
    sides, more = [2 * size], round(math.log2(max(1.0, math.sqrt(count) / size)))
    while more > 0:
        step = min(more, int(math.log2(2 * size)))
        sides.append(1 << step)
        more -= step
    return sides


def nearest_buckets(x: np.ndarray, signs: np.ndarray, sides: list[int], wanted: int) -> np.ndarray:
    """The numbers of the wanted buckets nearest to each row of x, nearest first.

    signs are one table's, (hashes, 3, size). A hash misses by the square of the gap
    between its side and the largest; a bucket misses by the sum over its hashes.
    """
    n = len(x)
    missed, bucket = np.zeros((n, 1)), np.zeros((n, 1), np.int64)
    for number, own in zip(sides, signs, strict=False):
        turned = rotated(x, own)[:, : (number + 1) // 2]
        here = np.stack([-turned, turned], axis=2).reshape(n, -1)[:, :number]
        gaps = (here.max(1, keepdims=True) - here) ** 2
        missed = (missed[:, :, None] + gaps[:, None, :]).reshape(n, -1)
        bucket = (bucket[:, :, None] * number + np.arange(number)).reshape(n, -1)
        order = np.argsort(missed, axis=1, kind="stable")[:, :wanted]
        missed, bucket = np.take_along_axis(missed, order, 1), np.take_along_axis(bucket, order, 1)
    return bucket


def usable(vector: Column) -> Column:
    """Not null or empty, all components finite and one of them not zero."""
    v = vector.cast("array<double>")
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _buckets(vectors: DataFrame, tables: int, probes: int, seed: int) -> DataFrame:
    """(id, v, dim, tbl, bucket) of vectors(id, v, n): a row for each table and each of the probes nearest buckets, for n vectors of that dimension."""

    def find(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lists = part.column("v")
            dims, counts = np.asarray(lists.value_lengths()), np.asarray(part.column("n"))
            for dim, count in np.unique(np.stack([dims, counts]), axis=1).T.tolist():
                rows = np.flatnonzero((dims == dim) & (counts == count))
                own = part.take(pa.array(rows))
                x = np.asarray(own.column("v").flatten(), np.float64).reshape(len(rows), dim)
                sides = hash_sides(1 << max(0, math.ceil(math.log2(dim))), count)
                signs = rotations(dim, tables, len(sides), seed)
                unit = np.zeros((len(rows), signs.shape[3]))
                # scaled first by the largest component, so that squares stay finite
                scaled = x / np.abs(x).max(1, keepdims=True)
                unit[:, :dim] = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
                for t in range(tables):
                    bucket = nearest_buckets(unit, signs[t], sides, probes)
                    again = own.take(pa.array(np.repeat(np.arange(len(rows)), bucket.shape[1])))
                    n = len(again)
                    yield pa.RecordBatch.from_arrays(
                        [again.column("id"), again.column("v"), pa.array(np.full(n, dim), pa.int32()), pa.array(np.full(n, t), pa.int32()), pa.array(bucket.ravel(), pa.int64())],
                        names=["id", "v", "dim", "tbl", "bucket"],
                    )

    return vectors.mapInArrow(find, f"id long, v {vectors.schema['v'].dataType.simpleString()}, dim int, tbl int, bucket long")


def _searched(vectors: DataFrame, queries: DataFrame, k: int, tables: int, probes: int, seed: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of every bucket that a query looks into."""
    index = _buckets(vectors, tables, 1, seed)
    looks = _buckets(queries, tables, probes, seed)
    # blocks: a large bucket is cut by hashes of the ids, on both sides
    sizes = index.groupBy("dim", "tbl", "bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    asks = looks.groupBy("dim", "tbl", "bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("asks"))
    grid = cut(sizes.join(asks, ["dim", "tbl", "bucket"]))
    key = ["dim", "tbl", "bucket"]
    left = (
        looks.join(grid, key)
        .withColumn("ask", F.pmod(F.xxhash64("id"), F.col("asks")).cast("int"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(*key, "ask", "part", "id", "v")
    )
    right = (
        index.join(grid, key)
        .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        .withColumn("ask", F.explode(F.sequence(F.lit(0), F.col("asks") - 1)))
        .select(*key, "ask", "part", "id", "v")
    )

    def rank(asked: pa.Table, there: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if asked.num_rows and there.num_rows:
            dim = asked.column("dim")[0].as_py()
            q, x = (np.asarray(t.column("v").combine_chunks().flatten(), np.float64).reshape(-1, dim) for t in (asked, there))
            ids = np.asarray(there.column("id"))
            repeated = len(np.unique(ids)) < len(ids)
            for query, vector in zip(asked.column("id").to_pylist(), q, strict=True):
                with np.errstate(over="ignore"):
                    away = np.sqrt(((x - vector) ** 2).sum(1))
                away[ids == query] = np.nan
                best = np.lexsort((ids, away))
                if repeated:  # an id with several vectors counts once, by the nearest of them
                    best = best[np.sort(np.unique(ids[best], return_index=True)[1])]
                best = best[: k + 1]
                best = best[~np.isnan(away[best])][:k]
                out[0].append(np.full(len(best), query))
                out[1].append(ids[best])
                out[2].append(away[best])
        join = lambda c, t: pa.array(np.concatenate(c) if c else [], t)
        return pa.table({"query_id": join(out[0], pa.int64()), "vec_id": join(out[1], pa.int64()), "score": join(out[2], pa.float64())})

    by = [*key, "ask", "part"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(rank, "query_id long, vec_id long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, tables: int = 12, probes: int = 16, seed: int = 7, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest vectors found for each query, by Euclidean distance.

    Ties go to the smaller id; a vector is no candidate for a query with its own
    id. Vectors that are null, empty, zero or hold null or non-finite components
    take no part, on either side, nor do rows with a null id; vectors are only
    compared with those of their own dimension. Rows that repeat an id and
    vector count once. Of identical vectors only the k + 1 with the smallest ids
    are indexed, as no other can be among a query's k. A query that finds fewer
    than k looks into all buckets of one table, which is exhaustive.
    """

    kept = ("array<float>", "array<double>")

    def clean(df: DataFrame) -> DataFrame:
        v = F.col(vector_column)
        v = v if df.schema[vector_column].dataType.simpleString() in kept and vectors.schema[vector_column].dataType == df.schema[vector_column].dataType else v.cast("array<double>")
        return df.where(F.col(id_column).isNotNull() & usable(F.col(vector_column))).select(F.col(id_column).cast("long").alias("id"), v.alias("v")).dropDuplicates(["id", "v"])

    same = Window.partitionBy("v").orderBy("id")
    index = written(clean(vectors).withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k + 1).select("id", "v"), "nearest-index")
    asked = clean(queries)
    counts = cut(index.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")))
    counted = lambda df: df.join(counts, F.size("v") == F.col("dim")).select("id", "v", "n")
    first = cut(_best(_searched(counted(index), counted(asked), k, tables, probes, seed), k))
    full = first.groupBy("query_id").count().where(F.col("count") >= k)
    short = cut(asked.join(full, F.col("id") == F.col("query_id"), "left_anti").withColumn("n", F.lit(0).cast("long")))
    if short.isEmpty():
        return first
    rest = _best(_searched(index.withColumn("n", F.lit(0).cast("long")), short, k, 1, 1 << 30, seed), k)
    return first.join(full, "query_id", "left_semi").unionByName(rest)
