"""Ranked lexical search by block maxima over variable blocks, exact per shard.

Documents are cut into shards where they lie, so no posting is shuffled. A task indexes
a shard, searches it for all items and lets it go before it takes the next: only texts
go to it, and only the best documents come from it. (As rows of a table, shards would be
megabytes each, many of which Parquet's writer and reader hold at once.) A
shard's index has, for each term, its postings in the order of documents, cut
into blocks of various sizes: dynamic programming chooses the boundaries that
minimise what the blocks' maxima overestimate, each block having a price. A search
adds, at each document of a shard, the weighted maxima of the blocks that lie
over it: WAND's test of a pivot, made for all documents of the shard at once. Where the sum is below
the least score that still counts, no posting is looked at; the others are
scored exactly, most promising first, so that the least score rises. Of blocks
with wide gaps the documents themselves are looked at, as pivots lie on postings only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHashes, cut, pieces, signed

#: Bytes of text, and documents, of one shard; a longer text is a shard of its own.
SHARD_BYTES, SHARD_DOCS = 8 << 20, 60_000
#: Longest block, and the price of one, in the measure of the impacts that it overestimates.
LONGEST_BLOCK, BLOCK_PRICE = 64, 1_000_000
#: Terms of items that are searched for at once; more items are searched for in several rounds.
ROUND_TERMS = 400_000
#: Items whose best documents leave a task at once.
ITEMS_OUT = 1_000

#: A block with fewer than one posting in so many documents is sparse.
SPARSE = 4

#: Bytes that belong to terms: ASCII letters and digits, and all of other characters.
IN_TERM = np.array([c >= 0x80 or chr(c).isalnum() for c in range(256)])


class Statistics(NamedTuple):
    """Documents with a term, and terms of all."""

    documents: int
    terms: int


def filled(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, text): rows that have both."""
    return df.where(F.col(id_column).isNotNull() & F.col(text_column).isNotNull()).select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))


def statistics(rows: DataFrame, wanted: np.ndarray) -> tuple[Statistics, np.ndarray]:
    """Of rows(text): the statistics, and how many have each of the wanted terms (sorted hashes)."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted) + 2, np.int64)
        for part in parts:
            for some in pieces(part.column("text")):
                words = WordHashes(some, lower=True, inside=IN_TERM)
                total[-2:] += np.array([(words.counts > 0).sum(), words.counts.sum()])
                if len(wanted):
                    hashes = words.of()
                    at = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
                    there = np.flatnonzero(wanted[at] == hashes)
                    text = np.repeat(np.arange(len(some)), words.counts)[there]
                    total[:-2] += np.bincount(np.unique(text * len(wanted) + at[there]) % len(wanted), minlength=len(wanted))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], names=["nth", "n"])

    total = np.zeros(len(wanted) + 2, np.int64)
    for r in rows.select("text").mapInArrow(count, "nth long, n long").groupBy("nth").agg(F.sum("n").alias("n")).collect():
        total[r.nth] = r.n
    return Statistics(*total[-2:].tolist()), total[:-2]


def damping(lengths: np.ndarray, known: Statistics) -> np.ndarray:
    """What a document's length adds to the occurrences of a term; 100 for one of mean length."""
    return 50 + (50 * lengths * known.documents) // max(1, known.terms)


def impacts(counts: np.ndarray, damped: np.ndarray) -> np.ndarray:
    """A posting's score but for the weight of its term."""
    return (1_000_000_000 * counts) // (1000 * counts + 20 * damped)


def cheapest_blocks(values: np.ndarray, sizes: np.ndarray, price: int = BLOCK_PRICE) -> np.ndarray:
    """For rows of values, of which the first sizes count: whether a block ends at each place.

    A block costs price and what its maximum overestimates each of its values by; the sum of all costs is least.
    """
    rows, width = values.shape
    cost = np.zeros((rows, width + 1), np.int64)
    taken = np.zeros((rows, width + 1), np.int64)
    for i in range(1, width + 1):
        back = values[:, i - 1 :: -1] if i == width else values[:, :i][:, ::-1]
        over = np.maximum.accumulate(back, 1) * np.arange(1, i + 1) - np.cumsum(back, 1)
        total = cost[:, :i][:, ::-1] + over
        best = total.argmin(1)
        cost[:, i] = total[np.arange(rows), best] + price
        taken[:, i] = best + 1
    ends = np.zeros((rows, width), bool)
    at = sizes.copy()
    while (open_ := np.flatnonzero(at > 0)).size:
        ends[open_, at[open_] - 1] = True
        at[open_] -= taken[open_, at[open_]]
    return ends


def block_ends(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where blocks end, one past their last value, of lists that follow each other; no block is longer than LONGEST_BLOCK.

    A list is cut into frames of that length, in each of which boundaries are chosen.
    """
    sizes = np.diff(offsets)
    frames = -(-sizes // LONGEST_BLOCK)
    of = np.repeat(np.arange(len(sizes)), frames)
    nth = np.arange(int(frames.sum())) - np.repeat(np.cumsum(frames) - frames, frames)
    start = offsets[:-1][of] + nth * LONGEST_BLOCK
    held = np.minimum(LONGEST_BLOCK, offsets[1:][of] - start)
    ends = np.zeros(len(values) + LONGEST_BLOCK, bool)
    ends[start[held == 1]] = True
    padded = np.concatenate([values, np.zeros(LONGEST_BLOCK, np.int64)])
    width = 2
    while width <= LONGEST_BLOCK:
        mine = np.flatnonzero((held > width // 2) & (held <= width) & (held > 1))
        for some in np.array_split(mine, max(1, -(-len(mine) * width // 400_000))):
            if len(some):
                at = start[some, None] + np.arange(width)
                inside = np.arange(width) < held[some, None]
                chosen = cheapest_blocks(np.where(inside, padded[at], 0), held[some])
                ends[at[chosen & inside]] = True
        width *= 2
    return np.flatnonzero(ends[: len(values)]) + 1


def index_of(ids: np.ndarray, texts: list[bytes | None], known: Statistics) -> dict[str, np.ndarray] | None:
    """A shard's index as flat arrays; None if no text has a term.

    Terms are 64-bit hashes of the maximal runs of ASCII letters, ASCII digits and other characters than ASCII,
    A-Z lower-cased; terms of up to eight bytes and one length never collide.
    """
    words = WordHashes(texts, lower=True, inside=IN_TERM)
    has = words.counts > 0
    if not has.any():
        return None
    lengths = words.counts[has].astype(np.int64)
    terms, term = np.unique(words.of(), return_inverse=True)
    places = term.astype(np.int64) * len(lengths) + np.repeat(np.arange(len(lengths)), lengths)
    places.sort()
    first = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    counts = np.diff(np.append(first, len(places)))
    docs = places[first] % len(lengths)
    offsets = np.searchsorted(places[first], np.arange(len(terms) + 1) * len(lengths))
    values = impacts(counts, damping(lengths, known)[docs])
    ends = block_ends(values, offsets)
    return {
        "ids": ids[has].astype("<i8"), "lengths": lengths.astype("<i8"), "terms": terms.astype("<u8"), "offsets": offsets.astype("<i8"), "docs": docs.astype("<u2"), "counts": counts.astype("<u4"),
        "block_ends": ends.astype("<i8"), "block_maxima": np.maximum.reduceat(values, np.append(0, ends[:-1])).astype("<u4"),
    }


KINDS = {"ids": "<i8", "lengths": "<i8", "terms": "<u8", "offsets": "<i8", "docs": "<u2", "counts": "<u4", "block_ends": "<i8", "block_maxima": "<u4"}


def cut_shards(parts: Iterator[pa.RecordBatch], most_bytes: int, most_docs: int) -> Iterator[tuple[np.ndarray, list[bytes | None]]]:
    """The ids and texts of parts(id, text), a shard at a time."""
    ids: list[np.ndarray] = []
    texts: list[bytes | None] = []
    held = 0
    for part in parts:
        own = np.asarray(part.column("id"))
        for some in pieces(part.column("text")):
            size = sum(len(t or b"") for t in some)
            full = held + size > most_bytes or len(texts) + len(some) > most_docs
            for k in range(0, len(some), most_docs):
                if texts and (k or full):
                    yield np.concatenate(ids), texts
                    ids, texts, held = [], [], 0
                texts += some[k : k + most_docs]
                ids.append(own[: len(some)][k : k + most_docs])
            own = own[len(some) :]
            held += size
    if texts:
        yield np.concatenate(ids), texts


def item_terms(items: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(item, term): each item's different terms."""

    def terms(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            own = np.asarray(part.column("id"))
            for some in pieces(part.column("text")):
                words = WordHashes(some, lower=True, inside=IN_TERM)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own[: len(some)], words.counts), pa.int64()), pa.array(signed(words.of()), pa.int64())], names=["item", "term"])
                own = own[len(some) :]

    return filled(items, id_column, text_column).mapInArrow(terms, "item long, term long").distinct()


class Best:
    """The best documents of an item so far: most scores first, then smaller ids."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.empty(0, np.int64), np.empty(0, np.int64)

    def least(self) -> int:
        """Scores below this no longer count."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


class Shard:
    """A shard's index, opened."""

    def __init__(self, arrays: dict[str, np.ndarray | bytes], known: Statistics):
        for n, kind in KINDS.items():
            setattr(self, n, np.frombuffer(arrays[n], kind))
        self.damped = damping(self.lengths, known)
        starts = np.append(0, self.block_ends[:-1])
        self.first_doc, self.last_doc = self.docs[starts].astype(np.int64), self.docs[self.block_ends - 1].astype(np.int64)
        self.starts, self.blocks = starts, np.searchsorted(starts, self.offsets)

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> int:
        """Adds the shard's documents that still count; gives the number of postings whose counts were looked at."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        there = self.terms[at] == terms
        at, weights = at[there], weights[there]
        if not len(at):
            return 0
        block, weight = _ranges(self.blocks[at], self.blocks[at + 1], weights)
        bound = weight * self.block_maxima[block]
        # blocks of dense terms count for all documents between their ends, those of sparse terms for the documents that have the term
        dense = (self.block_ends[block] - self.starts[block]) * SPARSE > self.last_doc[block] - self.first_doc[block]
        edges = np.zeros(len(self.ids) + 1, np.int64)
        np.add.at(edges, self.first_doc[block[dense]], bound[dense])
        np.subtract.at(edges, self.last_doc[block[dense]] + 1, bound[dense])
        above = np.cumsum(edges[:-1])
        posting, carried = _ranges(self.starts[block[~dense]], self.block_ends[block[~dense]], bound[~dense])
        np.add.at(above, self.docs[posting], carried)
        pivots = np.flatnonzero(above >= best.least())
        pivots = pivots[np.argsort(-above[pivots], kind="stable")]
        looked, size = 0, best.k
        while len(pivots):
            now, pivots, size = pivots[:size], pivots[size:], 2 * size
            chosen = np.zeros(len(self.ids) + 1, bool)
            chosen[now] = True
            before = np.cumsum(chosen) - chosen
            live = before[self.last_doc[block] + 1] > before[self.first_doc[block]]
            posting, factor = _ranges(self.starts[block[live]], self.block_ends[block[live]], weight[live])
            looked += len(posting)
            mine = chosen[self.docs[posting]]
            posting, factor = posting[mine], factor[mine]
            docs = self.docs[posting]
            scores = np.zeros(len(self.ids), np.int64)
            np.add.at(scores, docs, factor * impacts(self.counts[posting].astype(np.int64), self.damped[docs]))
            now = now[scores[now] >= best.least()]
            best.add(scores[now], self.ids[now])
            pivots = pivots[above[pivots] >= best.least()]
        return looked


def _ranges(starts: np.ndarray, ends: np.ndarray, carried: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, one range after another, and what each range carries for each of them."""
    sizes = (ends - starts).astype(np.int64)
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return shift + np.arange(int(sizes.sum())), np.repeat(carried, sizes)


def weight(frequency: int, known: Statistics) -> int:
    return math.floor(1000 * math.log((2 * known.documents + 2) / (2 * frequency + 1)))


def search_shards(rows: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """(item_id, doc_id, score): the best k documents of each task of rows(id, text) for every item of pairs(item, term), which is collected; see search."""
    asked = pairs.collect()
    item = np.array([r.item for r in asked], np.int64)
    wanted, nth = np.unique(np.array([r.term for r in asked], np.int64).view(np.uint64), return_inverse=True)
    known, frequencies = statistics(rows, wanted)
    weights = np.array([weight(n, known) for n in frequencies.tolist()], np.int64)
    order = np.lexsort((nth, item))
    order = order[frequencies[nth[order]] > 0]
    item, nth = item[order], nth[order]
    names, starts = np.unique(item, return_index=True)
    asked = rows.sparkSession.sparkContext.broadcast((names, np.append(starts, len(item)), wanted[nth], weights[nth]))

    def best_of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, starts, terms, weights = asked.value
        if not len(items):
            return
        best = [Best(k) for _ in items]
        for ids, texts in cut_shards(parts, SHARD_BYTES, SHARD_DOCS):
            if arrays := index_of(ids, texts, known):
                shard = Shard(arrays, known)
                for i in range(len(items)):
                    mine = slice(starts[i], starts[i + 1])
                    shard.search(terms[mine], weights[mine], best[i])
        for i in range(0, len(items), ITEMS_OUT):
            some = best[i : i + ITEMS_OUT]
            found = np.repeat(items[i : i + ITEMS_OUT], [len(b.ids) for b in some])
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), *(pa.array(np.concatenate([getattr(b, c) for b in some]), pa.int64()) for c in ("ids", "scores"))], names=["item_id", "doc_id", "score"])

    return rows.mapInArrow(best_of, "item_id long, doc_id long, score long")


def search(documents: DataFrame, items: DataFrame, k: int = 50, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of the highest scores above 0 for each item, ties to smaller ids.

    A score adds, for each different term of the item, the term's weight times the impact of its occurrences
    in the document, all in 64-bit integers. Null texts and texts without terms are found by nothing; rows with a null
    id take no part, in the statistics either. Rows that repeat a document's id are documents of their own; rows that
    repeat an item's id are one item with the terms of all. Items that find nothing have no row.
    """
    rows = filled(documents, id_column, text_column)
    pairs = cut(item_terms(items, item_column, item_text_column))
    rounds = max(1, -(-pairs.count() // ROUND_TERMS))
    found = None
    for r in range(rounds):
        some = search_shards(rows, pairs.where(F.pmod(F.xxhash64("item"), F.lit(rounds)) == r), k)
        found = some if found is None else found.unionByName(some)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
