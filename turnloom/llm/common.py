"""What several operators share: the shared folder, checked broadcasts, words."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What separates words: space, and the five ASCII controls from tab to carriage return.
SPACES = b" \t\n\x0b\x0c\r"
#: One word, as a regular expression for Java and Python alike.
WORD = r"[^\x20\x09-\x0D]+"
#: Ids up to this many are broadcast (8 bytes each, so 16 MB); above, a shuffled join is used.
BROADCAST_IDS = 2_000_000
#: Text handled at once inside a task, in bytes.
CHUNK_BYTES = 1 << 20

#: Bytes of an Arrow batch, about, and the setting that bounds them.
BATCH_BYTES, BATCH_BOUND = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"

MASK64 = (1 << 64) - 1


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    Where a local session names none, as in tests, a temporary one is set; a cluster must name it.
    """
    bound_batches(spark)
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="spark-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named.rstrip("/")


def bound_batches(spark: SparkSession) -> None:
    """Keeps Arrow batches of long texts small, unless the session sets its own bound: ten thousand rows can be any size."""
    if spark.conf.get(BATCH_BOUND, None) is None:
        spark.conf.set(BATCH_BOUND, str(BATCH_BYTES))


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint; for narrow rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """df written to Parquet in the shared folder and read again; for wide rows."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of one range of a written order, about, and ranges at most.
ORDER_ROWS, MOST_ORDERED = 50_000, 100_000


def in_order(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df range-sorted by order and written, plus at, which grows along the order, and part, its range's number.

    A range has about ORDER_ROWS rows, whatever the keys: no key has to fit in one task.
    """
    ranges = min(MOST_ORDERED, max(1, -(-df.count() // ORDER_ROWS)))
    rows = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    return written(rows.withColumn("part", F.shiftrightunsigned("at", 33).cast("int")), name)


def sums_before(df: DataFrame, keys: list[str], order: list[Column], amount: str, name: str) -> DataFrame:
    """df plus name: the sum of amount over all rows before, within keys[:-1]; keys[-1] is a range of the order."""
    sums = df.groupBy(*keys).agg(F.sum(amount).alias("_sum"))
    prior = Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*(F.col(k).alias(f"_{k}") for k in keys), F.coalesce(F.sum("_sum").over(prior), F.lit(0)).alias("_start"))
    match = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    both = df.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0))).join(starts, match)
    return both.withColumn(name, F.col("_start") + F.col("_inside")).drop("_start", "_inside", *(f"_{k}" for k in keys))


@contextmanager
def shuffled_joins(spark: SparkSession) -> Iterator[None]:
    """Joins that run meanwhile are shuffled, but for explicit broadcasts: many rounds of small broadcasts pile up with the driver."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    try:
        yield
    finally:
        for n, value in before.items():
            if value is None:
                spark.conf.unset(n)
            else:
                spark.conf.set(n, value)


def released(spark: SparkSession) -> None:
    """Lets plans, shuffles and checkpoints of rounds that are over go: Spark keeps them until the driver's JVM collects its garbage, and its heap grows meanwhile."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def keep_ids(df: DataFrame, ids: DataFrame, column: str, limit: int = BROADCAST_IDS) -> DataFrame:
    """Rows of df whose column is among ids; ids are broadcast only if at most limit.

    ids is counted, so it should be cheap to compute (checkpointed).
    """
    few = ids.count() <= limit
    return df.join(F.broadcast(ids) if few else ids, column, "left_semi")


def row_mark(documents: DataFrame, id_column: str, text_column: str) -> Column:
    """What tells rows of one id apart: a hash of the text where some id repeats, else 0.

    Rows of one id and text lose the same, so they need no telling apart.
    """
    ids = documents.where(F.col(id_column).isNotNull()).groupBy(id_column).agg(F.count("*").alias("n"))
    return F.lit(0).cast("long") if ids.where("n > 1").isEmpty() else F.xxhash64(text_column)


def fresh(df: DataFrame, name: str) -> str:
    """name, with underscores before it until df has no such column."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = f"_{name}"
    return name


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def binaries(array: pa.Array) -> list[bytes | None]:
    """An Arrow string array's UTF-8 bytes."""
    return array.cast(pa.binary()).to_pylist()


def chunks(texts: list[bytes | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about limit bytes each; a longer text is a range of its own."""
    start = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text or b"") > limit:
            yield start, i
            start, held = i, 0
        held += len(text or b"")
    if start < len(texts):
        yield start, len(texts)


def pieces(array: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[list[bytes | None]]:
    """An Arrow string array's UTF-8 bytes, about limit bytes at a time; a longer text comes alone."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(array), 0), np.int64))
    start = 0
    while start < len(array):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield binaries(array.slice(start, stop - start))
        start = stop


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, so that sums of word hashes become evenly spread."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    return np.array([pow(base, j, 1 << 64) for j in range(1, n + 1)], np.uint64)


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """The 64-bit hash of each run of n consecutive words, from the words' hashes."""
    count = len(h) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for j, p in enumerate(powers(n)):
        total += h[j : j + count] * p
    return mix(total)


_IN_WORD = np.array([chr(c) not in SPACES.decode() for c in range(256)])
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Longer words, in bytes, are hashed one by one.
_LONG = 64


class WordHashes:
    """The words of several texts, one text after another: how many each text has, and 64-bit hashes of all."""

    def __init__(self, texts: list[bytes | None], lower: bool = False, inside: np.ndarray = _IN_WORD):
        """lower: A-Z count as a-z. inside: whether each byte is part of a word; a space must not be."""
        whole = b" ".join([t or b"" for t in texts])
        self.whole = (whole.lower() if lower else whole) + b" " * 9
        inside = np.take(inside, np.frombuffer(self.whole, np.uint8))
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        edges = np.concatenate([np.zeros(int(inside[0]), np.int64), edges])
        self.starts, ends = edges[0::2], edges[1::2]
        self.lengths = ends - self.starts
        begins = np.cumsum([0] + [len(t or b"") + 1 for t in texts])
        self.counts = np.diff(np.searchsorted(self.starts, begins))

    def of(self, seed: int = 0) -> np.ndarray:
        """Every word's hash: its bytes are taken in by eights; words of up to eight bytes and of one length never collide."""
        eights = np.ndarray((len(self.whole) - 7,), "<u8", self.whole, 0, (1,))
        h = mix(self.lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03 + seed))
        active = np.arange(len(h))
        for at in range(0, _LONG, 8):
            taken = eights[self.starts[active] + at] & _FIRST_BYTES[np.minimum(self.lengths[active] - at, 8)]
            h[active] = mix((h[active] + np.uint64(at)) ^ taken)
            active = active[self.lengths[active] > at + 8]
            if not len(active):
                break
        for i in active.tolist():
            h[i] = xxhash.xxh3_64_intdigest(self.whole[self.starts[i] : self.starts[i] + self.lengths[i]], seed)
        return h


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
