"""N-gram Jaccard join by universe partitioning and the pigeonhole principle.

Sets are banded by size. For each band, hashing cuts the universe of shingles
into segments; two linked sets differ in at most H shingles, so of segments
whose allotments sum to more than H, one has fewer differences than its
allotment. An allotment of one asks for equal segments, one of two for segments
with at most one difference, found by one-deletion neighbourhoods. Costs decide,
band by band, how many segments get which allotment, and each set leaves out the
most crowded of its segments as far as a few spare ones allow. Candidates are
verified exactly.

Before any key is shuffled, a filter of the keys met twice (built like a Bloom
filter in every task and merged by segments) drops those of one set only.

Small buckets are expanded to pairs. A crowded one is not: all its members are
compared with one hub, a set that most of them meet, and go on by what they
differ from it in, shingles gained and lost alike. Two members are as far from
each other as both are from the hub together, less twice what those differences
share. So either both link with the hub, or they share a known number of
differences and meet again by the rarest of these: members of unlike distances
need to share so many that the crowded differences, which most members have, are
not looked at. Links are merged to components, and only pairs of different
components go on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .cells import batches, bitmap, cells_for, hit
from .common import BROADCAST_IDS, MASK64, WordHashes, cut, keep_ids, mix, pieces, powers, released, rolling, shuffled_joins, signed, written
from .components import components

#: A set leaves out keys whose buckets have more rows than this, as far as its spare allotments go.
CROWDED = 16
#: Rows of a bucket that is expanded to pairs: at first, and among buckets of a hub and a shingle. Larger ones get a hub.
PAIRED, PAIRED_LATER = 16, 64
#: Rounds of hubs. More follow as long as each halves the rows in crowded buckets; what is still crowded then is expanded.
HUB_ROUNDS = 3
#: Members compared with a copy of a hub in one task.
HUB_ROWS = 500
#: Spare segments of every scheme that has equal ones: so many, and one in so many.
SPARE, SPARE_EACH = 2, 10
#: What a segment of no or one shingle costs more than another, in keys.
THIN = 4
#: Bits of the filter that are set for each key, and cells for each key expected. Keys for each byte of text and
#: each difference that a shingle is allowed, about: two bands, with spare segments, over words of six bytes.
HASHES, CELLS_EACH, EACH_BYTE = 2, 4, 2.8 / 6
#: Cells a task gathers before it passes them on, and digests of sets it remembers so as to count copies once.
FLUSH, REMEMBERED = 1_000_000, 100_000


def band_starts(top: int, p: int, q: int) -> list[int]:
    """Smallest sizes of the bands up to top; sets that can link are in one band or in neighbouring ones."""
    starts = [1]
    while starts[-1] <= top:
        starts.append(starts[-1] * q // p + 1)
    return starts


def scheme(low: int, high: int, p: int, q: int) -> tuple[int, int, int]:
    """(H, equal, near): for pairs whose smaller set has low to high shingles.

    H is the largest symmetric difference of a linked pair; equal segments
    have allotment one, near segments two, and equal + 2 * near > H. The cost of a choice is
    its keys for each set, plus what segments of no or one shingle cost as their
    buckets are crowded. Equal segments include the spare ones: for those of few
    shingles, and some more, as a pair must then share more than one.
    """
    larger = high * q // p
    most = (high + larger) * (q - p) // (q + p)
    near = np.arange((most + 2) // 2 + 1)
    equal = np.maximum(0, most + 1 - 2 * near)
    # segments without any shingle, and near ones with at most one, whose buckets are crowded
    each = low / np.maximum(equal + near, 1)
    bare, thin = equal * np.exp(-each), near * np.exp(-each) * (1 + each)
    equal = equal + np.ceil(bare + 3 * np.sqrt(bare)).astype(np.int64) + 2 * np.ceil(thin + 3 * np.sqrt(thin)).astype(np.int64) + np.where(equal > 1, SPARE + equal // SPARE_EACH, 0)
    each = low / (equal + near)
    thin = np.where(equal + near > 1, np.exp(-each) * (1 + each), 0.0)
    best = int(np.argmin(equal + near + near * each + THIN * (equal + near) * thin))
    return most, int(equal[best]), int(near[best])


class Bands:
    """The schemes of all bands up to the largest size that was asked for."""

    def __init__(self, p: int, q: int):
        self.p, self.q = p, q
        self.start = self.high = self.most = self.equal = self.near = np.empty(0, np.int64)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        """The band of each size; -1 for 0."""
        top = int(sizes.max(initial=0))
        if not len(self.high) or self.high[-1] < top:
            starts = band_starts(max(2 * top, 1000), self.p, self.q)
            made = [scheme(a, b - 1, self.p, self.q) for a, b in zip(starts, starts[1:], strict=False)]
            self.start = np.array(starts[:-1], np.int64)
            self.high = np.array(starts[1:], np.int64) - 1
            self.most, self.equal, self.near = np.array(made, np.int64).T
        return np.searchsorted(self.start, sizes, "right") - 1

    @property
    def spare(self) -> np.ndarray:
        """How many allotments a set may leave out."""
        return self.equal + 2 * self.near - self.most - 1


def shingle_sets(texts: list[bytes | None], n: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts' distinct hashed shingles, sorted within each text, and how many each text has.

    A text with fewer than n words is one shingle as a whole.
    """
    words = WordHashes(texts, lower=True)
    counts, lo = words.counts, words.of()
    runs = rolling(lo, n)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    ends = np.cumsum(sizes)
    out = np.empty(int(sizes.sum()), np.uint64)
    at = 0
    for count, end, size in zip(counts.tolist(), ends.tolist(), sizes.tolist(), strict=True):
        if count >= n:
            own = out[end - size : end]
            own[:] = runs[at : at + size]
            own.sort()
        elif count:
            out[end - 1] = (int((lo[at : at + count] * powers(count, 0xD6E8FEB86659FD93)).sum()) + count) & MASK64
        at += count
    text = np.repeat(np.arange(len(counts)), sizes)
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (text[1:] != text[:-1])
    return out[new], np.bincount(text[new], minlength=len(counts))


def index_keys(tokens: np.ndarray, sizes: np.ndarray, bands: Bands) -> tuple[np.ndarray, ...]:
    """Index entries of sets that lie one after another, for each set's own band and the one below.

    Returns (key, set, kind, allotment, band, most, spare): kind 0 is a segment, 1 a
    segment less one shingle; most is the scheme's H; spare is how many allotments the set may leave out.
    """
    own = bands.of(sizes)
    of = np.repeat(np.arange(len(sizes)), sizes)
    spread = mix(tokens ^ np.uint64(0xA0761D6478BD642F))
    made = []
    for band in (own, own - 1):
        known = np.maximum(band, 0)
        # sets of the band above take part as the larger of a pair; without differences, only equal sets can link
        use = (band >= 0) & (bands.most[known] > 0) & (bands.high[known] * bands.q // bands.p >= sizes)
        rows = np.flatnonzero(use)
        if not len(rows):
            continue
        inside = use[of]
        hashes = spread[inside]
        at = np.repeat(np.arange(len(rows)), sizes[rows])
        band = band[rows]
        equal, segments = bands.equal[band], bands.equal[band] + bands.near[band]
        begin = np.cumsum(segments) - segments
        place = (hashes % segments[at].astype(np.uint64)).astype(np.int64)
        slot = begin[at] + place
        whose = np.repeat(np.arange(len(rows)), segments)
        number = np.arange(len(whose)) - begin[whose]
        sums = np.zeros(len(whose), np.uint64)
        np.add.at(sums, slot, hashes)
        salt = mix(number.astype(np.uint64) + ((band[whose] << 32) | 1).astype(np.uint64))
        near = number >= equal[whose]
        made.append((mix(sums + salt), rows[whose], np.zeros(len(whose)), 1 + near, band[whose], bands.most[band][whose], bands.spare[band][whose]))
        less = np.flatnonzero(place >= equal[at])
        if len(less):
            slot, at = slot[less], at[less]
            ones = np.ones(len(less))
            made.append((mix(sums[slot] - hashes[less] + salt[slot]), rows[at], ones, 2 * ones, band[at], bands.most[band][at], bands.spare[band][at]))
    types = (np.uint64, np.int64, np.int8, np.int8, np.int16, np.int32, np.int32)
    if not made:
        return tuple(np.empty(0, t) for t in types)
    return tuple(np.concatenate(c).astype(t) for c, t in zip(zip(*made, strict=True), types, strict=True))


def _cells(keys: np.ndarray, size: int) -> list[np.ndarray]:
    return [((keys if k == 0 else mix(keys)) % np.uint64(size)).astype(np.int64) for k in range(HASHES)]


def _sets(texts: DataFrame, n: int, p: int, q: int, size: int) -> DataFrame:
    """Two kinds of rows: (id, n_shingles, hi, lo), each text's number of shingles and a 128-bit hash of its set;
    and (segment, once, twice), the cells that the keys of a task's different sets hit.
    """
    schema = pa.schema([("id", pa.int64()), ("n_shingles", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("segment", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])

    def sets(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(p, q)
        held: list[np.ndarray] = []
        seen: set[bytes] = set()

        def flush() -> Iterator[pa.RecordBatch]:
            cells, count = np.unique(np.concatenate([c for keys in held for c in _cells(keys, size)]), return_counts=True)
            for batch in batches(cells, cells[count > 1]):
                empty = [pa.nulls(len(batch), pa.int64())] * 4
                yield pa.RecordBatch.from_arrays([*empty, *batch.columns], schema=schema)

        kept = 0
        for part in parts:
            if not len(part):
                continue
            counts, whole = [], []
            for some in pieces(part.column("text")):
                tokens, sizes = shingle_sets(some, n)
                ends = np.cumsum(sizes)
                digests = [xxhash.xxh3_128_digest(tokens[b - s : b].tobytes()) for b, s in zip(ends.tolist(), sizes.tolist(), strict=True)]
                new = np.zeros(len(sizes), bool)
                for i, digest in enumerate(digests):
                    if sizes[i] and digest not in seen:
                        new[i] = True
                        if len(seen) < REMEMBERED:
                            seen.add(digest)
                counts.append(sizes)
                whole += digests
                held.append(index_keys(tokens[np.repeat(new, sizes)], sizes[new], bands)[0])
                kept += len(held[-1])
                if kept * HASHES > FLUSH:
                    yield from flush()
                    held, kept = [], 0
            halves = np.frombuffer(b"".join(whole), np.int64).reshape(-1, 2)
            made = [part.column("id"), *(pa.array(c, pa.int64()) for c in (np.concatenate(counts), halves[:, 0], halves[:, 1]))]
            yield pa.RecordBatch.from_arrays([*made, *(pa.nulls(len(part), t) for t in schema.types[4:])], schema=schema)
        if kept:
            yield from flush()

    return texts.mapInArrow(sets, "id long, n_shingles long, hi long, lo long, segment int, once binary, twice binary")


def _entries(texts: DataFrame, n: int, p: int, q: int, size: int, twice: Broadcast) -> DataFrame:
    """(key, id, size, kind, allotment, band, most, spare): the index entries of every text whose keys the filter holds twice."""
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("size", pa.int32()), ("kind", pa.int8()), ("allotment", pa.int8()), ("band", pa.int16()), ("most", pa.int32()), ("spare", pa.int32())])

    def entries(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, there = Bands(p, q), twice.value
        for part in parts:
            ids = np.asarray(part.column("id"))
            for some in pieces(part.column("text")):
                tokens, sizes = shingle_sets(some, n)
                own, ids = ids[: len(sizes)], ids[len(sizes) :]
                key, row, *rest = index_keys(tokens, sizes, bands)
                met = np.flatnonzero(hit(there, _cells(key, size)[0]))
                for cells in _cells(key[met], size)[1:]:
                    kept = hit(there, cells)
                    met = met[kept]
                row = row[met]
                made = (signed(key[met]), own[row], sizes[row], *(c[met] for c in rest))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(made, schema.types, strict=True)], schema=schema)

    return texts.mapInArrow(entries, "key long, id long, size int, kind byte, allotment byte, band short, most int, spare int")


def _fits(one: str, two: str, p: int, q: int) -> str:
    """SQL: sizes that a linked pair can have."""
    return f"least({one}, {two}) * {q} >= greatest({one}, {two}) * {p}"


def _pairs(small: DataFrame, apart: DataFrame | None, p: int, q: int) -> DataFrame:
    """(a, b): pairs of different components in one bucket of small, a < b, without those that can't link by count.

    Segments that don't match differ by their allotments at least, so what
    matches is over the scheme's H less the most that a pair of these sizes may
    differ in, and by all spare allotments but those left out. apart(id, band, there, left)
    has what a set may match in elsewhere, and what it has left out.
    """
    names = ("id", "size", "kind", "component", *(["side"] if apart is None and "side" in small.columns else []))
    pairs = small.join(small.select("key", *(F.col(c).alias(f"{c}2") for c in names), F.col("band").alias("band2")), "key")
    pairs = pairs.where("id < id2 and band = band2 and kind + kind2 < 2 and component <> component2").where(_fits("size", "size2", p, q))
    if "side" in names:
        pairs = pairs.where("side = 0 or side <> side2")
    if apart is None:
        return pairs.select(F.col("id").alias("a"), F.col("id2").alias("b")).distinct()
    added = pairs.groupBy("id", "id2", "band").agg(F.sum("allotment").alias("shared"), *(F.first(c).alias(c) for c in ("size", "size2", "most", "spare")))
    # in whole numbers: the least intersection of a linked pair is p * total / (p + q), rounded up
    differ = f"size + size2 - 2 * (({p} * (size + size2) + {p + q - 1}) div {p + q})"
    asked = added.withColumn("over", F.expr(f"most - ({differ}) - shared"))
    two = apart.withColumnsRenamed({"id": "id2", "there": "there2", "left": "left2"})
    both = asked.join(apart, ["id", "band"], "left").join(two, ["id2", "band"], "left")
    can = both.where("least(coalesce(there, 0), coalesce(there2, 0)) > over + spare - greatest(coalesce(left, 0), coalesce(left2, 0))")
    return can.select(F.col("id").alias("a"), F.col("id2").alias("b")).distinct()


def _hubs(crowded: DataFrame) -> DataFrame:
    """(a, b, least): every member b of a crowded bucket with the bucket's hub a, and the size of the hub's smallest member.

    A set's weight is the rows that it meets. A bucket's heaviest set is what its
    members may choose; each chooses the heaviest it is offered in any bucket,
    and the bucket takes what most of its members chose. Each step is written: planned as
    one, they were thirty shuffles, whose plan the driver made anew after each.
    """
    weight = crowded.groupBy("id").agg(F.sum("rows").alias("weight"))
    heaviest = written(crowded.join(weight, "id").groupBy("key").agg(F.max(F.struct("weight", -F.col("id"))).alias("heaviest")), "jaccard-heaviest")
    offered = crowded.select("key", "id", "size").join(heaviest, "key")
    chosen = written(offered.groupBy("id").agg(F.max("heaviest").alias("heaviest")).select("id", (-F.col("heaviest")["col2"]).alias("choice")), "jaccard-chosen")
    votes = crowded.select("key", "id").join(chosen, "id").groupBy("key", "choice").count()
    hub = written(votes.groupBy("key").agg(F.max(F.struct("count", -F.col("choice"))).alias("most")).select("key", (-F.col("most")["col2"]).alias("a")), "jaccard-hubs")
    pairs = written(crowded.select("key", F.col("id").alias("b"), "size").join(hub, "key").groupBy("a", "b").agg(F.first("size").alias("size")), "jaccard-members")
    least = pairs.groupBy("a").agg(F.min("size").alias("least"))
    return written(pairs.where("a <> b").join(least, "a").select("a", "b", "least"), "jaccard-spokes")


def _compared(pairs: DataFrame, texts: DataFrame, n: int, p: int, q: int) -> DataFrame:
    """pairs(a, b, least) plus size, the number of b's shingles, size_a, common, linked, and keys.

    least is null for plain pairs. For those with a hub a, keys are the hub with
    each shingle that only one of the two has.
    """
    sides = cut(pairs.groupBy("a").agg(F.ceil(F.count("*") / HUB_ROWS).cast("int").alias("parts")))
    involved = cut(pairs.select(F.col("b").alias("id")).unionByName(sides.select(F.col("a").alias("id"))).distinct())
    texts = written(keep_ids(texts, involved, "id"), "jaccard-texts")
    part = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part")
    right = pairs.join(sides, "a").select("a", part, "b", "least").join(texts.withColumnRenamed("id", "b"), "b")
    left = sides.join(texts.withColumnRenamed("id", "a"), "a").select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"), F.lit(None).cast("int").alias("least"), "text")
    # a's text comes first, once for each part of its pairs
    rows = right.select("a", "part", "b", "least", "text").unionByName(left).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("least", pa.int32()), ("size", pa.int32()), ("size_a", pa.int32()), ("common", pa.int32()), ("linked", pa.bool_()), ("keys", pa.list_(pa.int64()))])

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = np.empty(0, np.uint64)
        for part in parts:
            columns = [part.column(c).to_pylist() for c in ("a", "b", "least")]
            rows = list(zip(*columns, strict=True))
            for some in pieces(part.column("text")):
                tokens, sizes = shingle_sets(some, n)
                out: list[tuple] = []
                end = 0
                for (a, b, least), size in zip(rows[: len(sizes)], sizes.tolist(), strict=True):
                    two = tokens[end : end + size]
                    end += size
                    if b is None:
                        one = two.copy()
                        continue
                    there = one[np.minimum(np.searchsorted(one, two), len(one) - 1)] == two
                    common = int(there.sum())
                    keys = None
                    if least is not None:
                        lost = np.ones(len(one), bool)
                        lost[np.searchsorted(one, two[there])] = False
                        keys = signed(mix(np.concatenate([two[~there], one[lost]]) ^ mix(np.array([a], np.int64).view(np.uint64))))
                    out.append((a, b, least, size, len(one), common, q * common >= p * (len(one) + size - common), keys))
                rows = rows[len(sizes) :]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    return written(rows.mapInArrow(compare, "a long, b long, least int, size int, size_a int, common int, linked boolean, keys array<long>"), "jaccard-compared")


def _onward(compared: DataFrame, p: int, q: int) -> DataFrame:
    """(key, id, size, side): where members of a hub meet that may link, but don't both link with it.

    With d shingles that only one of a member and the hub has, a member's level is
    (p + q) * d - (q - p) * size. Two members link when they share as many of these
    shingles as their levels add up to, divided by 2 * (p + q). If that is none, both
    link with the hub. Else the rarest one that they share is so early among the d of
    each, rarest first, that as many can follow. Members are met class by class of
    levels, as far from their own as linked ones can be; a member's side tells
    whether its class is the lower one (-1), the upper one (1) or both (0).
    """
    members = compared.where("least is not null").withColumn("d", F.expr("size + size_a - 2 * common"))
    each = members.select("a", "b", "size", "size_a", "d", F.explode("keys").alias("x"))
    # what one member alone has comes first and meets nobody
    several = each.groupBy("x").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(each.join(several, "x"), "jaccard-differences")
    own = Window.partitionBy("a", "b")
    ranked = shared.withColumn("after", F.count("*").over(own) - F.row_number().over(own.orderBy("n", "x")))
    down = lambda x: f"(({x}) - pmod({x}, width)) div width"
    levels = ranked.withColumn("width", F.expr(f"greatest({q - p}L * size_a div 2, 1L)")).withColumn("level", F.expr(f"{p + q}L * d - {q - p} * size"))
    low = f"greatest({down(f'level - 2 * {q - p} * ({q} * size div {p})')}, {down('1 - level')})"
    high = down(f"2 * {p + q} * (after + 1) - level")
    ranges = levels.select("x", "b", "size", F.expr(down("level")).alias("mine"), F.expr(low).alias("low"), F.expr(high).alias("high")).where("low <= high")
    met = ranges.withColumn("other", F.explode(F.expr("sequence(low, high)")))
    return met.select(F.xxhash64("x", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"), F.col("b").alias("id"), "size", F.signum(F.col("mine") - F.col("other")).cast("byte").alias("side"))


def _links(firsts: DataFrame, entries: DataFrame, n: int, p: int, q: int) -> DataFrame:
    """(id, component) of the texts firsts(id, text) that link with others, from their index entries."""
    spark = firsts.sparkSession
    bucket = Window.partitionBy("key")
    # a set leaves out its most crowded keys, as far as its scheme's spare allotments go. Of the keys that a linked
    # pair shares, both leave out the first few in the same order, so that others stay
    crowded = F.col("rows") > CROWDED
    order = Window.partitionBy("id", "band", crowded).orderBy(F.col("rows").desc(), "key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stays = ~crowded | (F.col("_sum") > F.col("spare"))
    sifted = written(entries.withColumn("_sum", F.sum("allotment").over(order)).withColumn("stays", stays).drop("_sum", "rows"), "jaccard-sifted")
    now = sifted.where("stays").drop("stays").withColumn("component", F.col("id"))
    seen: DataFrame | None = None
    nothing = spark.createDataFrame([], "a long, b long")
    known: DataFrame | None = None
    turn = before = 0
    while True:
        counts = {"rows": F.count("*").over(bucket), "several": F.min("component").over(bucket) < F.max("component").over(bucket)}
        if turn == 0:
            full = F.col("rows") > PAIRED
        else:
            counts["below"] = F.count_if(F.col("side") < 0).over(bucket)
            # as many pairs for each row as in a bucket of so many; of two classes, pairs are of one and the other
            full = F.expr(f"if(side = 0, rows * (rows - 1), 2 * below * (rows - below)) > rows * {PAIRED_LATER - 1}")
        now = now.withColumns(counts).where("several" if turn == 0 else "several and (side = 0 or below > 0 and below < rows)")
        now = written(now.withColumn("full", full).drop("several", "below"), "jaccard-slim")
        crowded = now.where("full")
        many = crowded.count()
        hubs = many > 0 and (turn < HUB_ROUNDS or 2 * many <= before)
        before = many
        small = now.where("not full") if hubs else now
        apart = None
        if turn == 0:
            elsewhere = crowded.groupBy("id", "band").agg(F.sum("allotment").alias("there"))
            apart = written(elsewhere.join(sifted.where("not stays").groupBy("id", "band").agg(F.sum("allotment").alias("left")), ["id", "band"], "full"), "jaccard-apart")
        pairs = written(_pairs(small, apart, p, q), "jaccard-met")
        if seen is not None:
            pairs = pairs.join(seen, ["a", "b"], "left_anti")
        pairs = written(pairs.withColumn("least", F.lit(None).cast("int")), "jaccard-plain")
        if hubs:
            pairs = pairs.unionByName(_hubs(crowded))
        released(spark)
        if pairs.isEmpty():
            break
        compared = _compared(pairs, firsts, n, p, q)
        found = cut(compared.where("linked").select("a", "b"))
        if known is None or not found.isEmpty():
            # links found before are taken as their stars
            known = components(found if known is None else found.unionByName(known.select(F.col("id").alias("a"), F.col("component").alias("b"))))
        released(spark)
        if not hubs:
            break
        done = compared.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        seen = done if seen is None else seen.unionByName(done)
        plain = {"kind": F.lit(0).cast("byte"), "band": F.lit(0).cast("short")}
        onward = written(_onward(compared, p, q), "jaccard-onward")
        now = onward.join(known, "id", "left").withColumns(plain | {"component": F.coalesce("component", "id")})
        turn += 1
    return known if known is not None else components(nothing)


def near_duplicates(documents: DataFrame, n: int = 5, threshold: tuple[int, int] = (4, 5), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row of documents.

    A text's set holds its distinct runs of n words, with A-Z lower-cased; a text with
    fewer words is one shingle as a whole, one without words or null has the
    empty set and links with nothing. Two texts link when threshold[1] *
    intersection >= threshold[0] * union; component_id is the smallest id
    reachable by links, itself included. Shingles are compared by 64-bit hashes.
    A row with a null id links with nothing and has a null component. Rows that
    repeat an id count as one document, that of the greatest text among them.
    """
    p, q = threshold
    texts = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    each = texts.groupBy("id").agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes"))
    measured = each.agg(F.sum("bytes").alias("bytes"), F.max(F.when(F.col("id").isNotNull(), F.col("rows"))).alias("rows")).first()
    if (measured.rows or 0) > 1:
        one = texts.where("id is not null").groupBy("id").agg(F.max("text").alias("text"))
        found = near_duplicates(written(one.unionByName(texts.where("id is null")), "jaccard-documents"), n, threshold, "id", "text")
        again = texts.select("id").where("id is not null").join(found, "id")
        return again.unionByName(found.where("id is null"))
    size = cells_for((measured.bytes or 0) * EACH_BYTE * (1 + q / p) * (q - p) / (q + p), CELLS_EACH)
    first_pass = written(_sets(texts, n, p, q, size), "jaccard-sets")
    sets = first_pass.where("segment is null").select("id", "n_shingles", "hi", "lo")
    twice = documents.sparkSession.sparkContext.broadcast(bitmap(first_pass.where("segment is not null").select("segment", "once", "twice"), size))
    filled = sets.where("n_shingles > 0 and id is not null")
    equal = cut(filled.groupBy("hi", "lo").agg(F.min("id").alias("first")))
    firsts = keep_ids(texts, equal.select(F.col("first").alias("id")), "id")

    # the index: entries that meet others
    bucket = Window.partitionBy("key")
    entries = _entries(firsts, n, p, q, size, twice).withColumns(
        {"rows": F.count("*").over(bucket), "whole": F.count_if(F.col("kind") == 0).over(bucket), "two": F.min("id").over(bucket) < F.max("id").over(bucket)}
    )
    met = written(entries.where("two and whole > 0").drop("two", "whole"), "jaccard-entries")
    twice.destroy()  # the filter has done its work: drivers and executors need not hold it through the rounds
    with shuffled_joins(documents.sparkSession):
        found = _links(firsts, met, n, p, q)
    reached = equal.join(found, F.col("first") == F.col("id"), "left").select("hi", "lo", F.coalesce("component", "first").alias("component_id"))
    own = F.when(F.col("n_shingles") > 0, F.col("component_id"))
    return sets.join(reached, ["hi", "lo"], "left").select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce(own, F.col("id"))).alias("component_id"))


def one_of_each(documents: DataFrame, n: int = 5, threshold: tuple[int, int] = (4, 5), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """documents without those that link, directly or by others, with a smaller id; columns unchanged.

    Of rows that repeat an id all stay or go; rows with a null id stay.
    """
    found = near_duplicates(documents, n, threshold, id_column, text_column)
    gone = cut(found.where("component_id < id").select(F.col("id").alias(id_column)).distinct())
    few = gone.count() <= BROADCAST_IDS
    return documents.join(F.broadcast(gone) if few else gone, id_column, "left_anti").select(*documents.columns)
