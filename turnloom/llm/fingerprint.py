"""Document fingerprints: a homomorphic multiset hash of a text's paragraphs.

Each paragraph is hashed to a wide vector of small signed numbers; a text's
fingerprint is the sum of its paragraphs' vectors, each lane modulo a power of
two. The order of paragraphs does not matter, and one is put in or taken out by
adding or subtracting its vector. As lanes are random and signed, the cosine of
two fingerprints estimates how much of their paragraphs two texts share.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Lanes of a fingerprint: four of 16 bits from each 64-bit hash.
LANES = 64
#: A lane is kept modulo two to this power.
LANE_BITS = 32
#: Rows of ids and buckets that are broadcast, at most (about 100 bytes each, so 50 MB); above, a shuffled join is used.
BROADCAST_ROWS = 500_000
#: Where a text is cut into paragraphs: at line ends, and after the end of a sentence.
PARAGRAPH = r"\n|(?<=[.!?]) "

_MODULUS = 1 << LANE_BITS


def paragraphs(text: Column, pattern: str = PARAGRAPH) -> Column:
    """The text's non-empty paragraphs; none for a null or empty text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), pattern, -1), lambda p: p != "")


def _hash(paragraph: Column, k: int) -> Column:
    """The paragraph's k-th hash; k comes first, as its hash is the seed of the paragraph's."""
    return F.xxhash64(F.lit(k), paragraph)


def lane_sums(paragraph: Column, hashes: list[Column]) -> list[Column]:
    """One aggregate for each lane: the sum of the paragraphs' signed 16-bit values."""
    return [F.sum(F.when(paragraph.isNotNull(), F.shiftrightunsigned(h, 16 * j).bitwiseAND(0xFFFF) - 32768)) for h in hashes for j in range(4)]


def reduced(lane: Column) -> Column:
    """A lane modulo the power, from -2^(bits-1) up."""
    return F.pmod(F.coalesce(lane, F.lit(0)) + _MODULUS // 2, F.lit(_MODULUS)) - _MODULUS // 2


def fingerprints(df: DataFrame, keys: list[str], text_column: str, pattern: str = PARAGRAPH) -> DataFrame:
    """df's keys plus lanes, array<long>: the fingerprint of the rows' texts.

    Rows with equal keys are summed, which gives the fingerprint of their texts
    together. Where df is dealt out by some of the keys, nothing is shuffled.
    A null or empty text, or one of line ends only, has all lanes zero.
    """
    pieces = df.select(*keys, F.explode_outer(paragraphs(F.col(text_column), pattern)).alias("_p"))
    names = [f"_h{k}" for k in range(LANES // 4)]
    hashed = pieces.select(*keys, "_p", *(_hash(F.col("_p"), k).alias(n) for k, n in enumerate(names)))
    sums = [c.alias(f"_l{i}") for i, c in enumerate(lane_sums(F.col("_p"), [F.col(n) for n in names]))]
    return hashed.groupBy(*keys).agg(*sums).select(*keys, F.array(*(reduced(F.col(f"_l{i}")) for i in range(LANES))).alias("lanes"))


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of two texts' paragraphs together, or of a's without b's (sign -1)."""
    return F.zip_with(a, b, lambda x, y: reduced(x + sign * y))


def as_string(lanes: Column) -> Column:
    """A fingerprint as lowercase hex, 8 digits a lane."""
    return F.array_join(F.transform(lanes, lambda x: F.lower(F.lpad(F.hex(F.pmod(x, F.lit(_MODULUS))), LANE_BITS // 4, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: 1 for equal fingerprints, else the cosine, 0 where negative or one side is empty."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    dot = total(F.zip_with(a, b, lambda x, y: x.cast("double") * y))
    norm = F.sqrt(total(F.transform(a, lambda x: x.cast("double") * x)) * total(F.transform(b, lambda x: x.cast("double") * x)))
    cosine = F.when(norm > 0, dot / norm).otherwise(F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(cosine, F.lit(1.0))))


def with_next(documents: DataFrame, id_column: str, text_column: str, bucket_rows: int = 2000) -> DataFrame:
    """(bucket, nth, guest, id, n_chars, text, next_text): each text with that of the next id, the first after the last.

    Ids are cut into buckets of about bucket_rows neighbours by range. A bucket also gets a
    guest row: the first row of the next bucket that has any (the first
    bucket's, for the last). So each text moves once, and each bucket is a
    sorted run of its own. Rows that repeat an id follow each other by text;
    rows with a null id come first.
    """
    texts = documents.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    count = documents.count()
    buckets = max(1, -(-count // bucket_rows))
    ids = documents.select(F.col(id_column).cast("long").alias("id"))
    # ranges by sampled ids, fixed by the checkpoint; then a bucket's bounds are the ids it begins and ends with
    dealt = cut(ids.distinct().repartitionByRange(buckets, "id").select("id", F.spark_partition_id().alias("bucket")))
    firsts = dealt.groupBy("bucket").agg(F.min(F.struct("id")).alias("first"))
    ring = Window.orderBy("bucket")
    target = F.coalesce(F.lag("bucket").over(ring), F.last("bucket").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    guests = firsts.select(F.col("first.id").alias("id"), target.alias("bucket"), F.lit(True).alias("guest"))
    homes = dealt.unionByName(guests, allowMissingColumns=True).withColumn("guest", F.coalesce("guest", F.lit(False)))
    homes = homes.withColumnRenamed("id", "_id")
    named = texts.join(F.broadcast(homes) if count <= BROADCAST_ROWS else homes, F.col("id").eqNullSafe(F.col("_id"))).drop("_id")
    order = Window.partitionBy("bucket").orderBy("guest", F.col("id").asc_nulls_first(), "text")
    return named.select(
        "bucket", F.row_number().over(order).alias("nth"), "guest", "id", F.length("text").cast("long").alias("n_chars"), "text", F.coalesce(F.lead("text").over(order), F.lit("")).alias("next_text")
    )


def edited_fingerprints(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", pattern: str = PARAGRAPH) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likenesses.

    The edited text has its last floor(n_chars / 2) code points replaced by the
    first as many (or all) of the next document's, by ascending id; the first
    follows the last. Columns: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. A null text is an empty one; a
    single document is followed by itself. Rows that repeat an id are documents
    of their own, by text.
    """
    rows = with_next(documents, id_column, text_column)
    half = F.shiftright("n_chars", 1).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next_text", F.lit(1), half))
    keys = ["bucket", "nth", "guest", "id", "n_chars", "edited_sha256"]
    both = rows.withColumn("edited", edited).withColumn("edited_sha256", F.sha2("edited", 256))
    sides = both.select(*keys, F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("t")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("t")))).alias("s")).select(*keys, "s.side", "s.t")
    made = fingerprints(sides, [*keys, "side"], "t", pattern)
    pair = made.groupBy(*keys).agg(*(F.first(F.when(F.col("side") == k, F.col("lanes")), True).alias(n) for k, n in ((0, "own"), (1, "changed"))))
    after = F.lead("own").over(Window.partitionBy("bucket").orderBy("nth"))
    placed = pair.withColumn("following", after).where(~F.col("guest"))
    return placed.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        as_string(F.col("own")).alias("fingerprint"),
        as_string(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
