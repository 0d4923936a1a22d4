"""Substring dedup: a count-min prefilter, then exact grouping of likely repeats.

Every run of `window` consecutive words is a window. Its count is kept in a
count-min sketch under the window's representative, the smallest of the hashed
shorter runs inside it: equal windows have equal representatives, so a sketch of
these overestimates the windows' counts, and has a fraction of the entries.
The partitions' sketches are merged by segments. A second pass hashes windows
to 96 bits and groups exactly those that may be in two documents; a window that
a task has already met in a smaller document is decided there, so a group has
at most one document for each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cells import MOST_CELLS, SCHEMA, batches, bitmap, cells_for, hit
from .common import WordHashes, binaries, fresh, mix, pieces, rolling, row_mark, signed

#: Rows of the sketch, and cells of one row for each representative expected.
ROWS, CELLS_EACH = 2, 3
#: Representatives for each byte of text, about: words of six bytes, two in seven of them.
EACH_BYTE = 2 / 7 / 6
#: Cells, or likely repeats, that a task gathers before it passes them on.
FLUSH = 4_000_000


def _inner(window: int) -> int:
    """Words of the shorter runs of which one represents a window."""
    return max(1, window - 5)


def representatives(hashes: np.ndarray, window: int) -> np.ndarray:
    """For each window, the smallest hash of the shorter runs in it."""
    runs = rolling(hashes, _inner(window))
    size = window - _inner(window) + 1
    n = len(runs) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    least = runs[:n].copy()
    for j in range(1, size):
        np.minimum(least, runs[j : j + n], out=least)
    return least


def _places(reps: np.ndarray, width: int) -> list[np.ndarray]:
    """A cell for each row of the sketch; the rows follow each other."""
    spread = mix(reps)
    return [((reps if r == 0 else spread) % np.uint64(width)).astype(np.int64) + r * width for r in range(ROWS)]


def _within(counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For windows over several texts' words in a row: whether each lies in one text, its text, its place there."""
    total = int(counts.sum())
    text = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    n = max(0, total - window + 1)
    return text[:n] == text[total - n :], text[:n], place[:n]


def covered(documents: DataFrame, window: int, id_column: str, text_column: str, mark: Column) -> DataFrame:
    """(id, mark, runs): for rows that lose words, runs of windows that start in a smaller document too; mark tells rows of one id apart.

    A run is its first window's word number times 2^32 plus its number of windows.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col(id_column).cast("long").alias("id"), mark.alias("mark"), F.col(text_column).alias("text")).where("id is not null")
    size = texts.select(F.sum(F.octet_length("text"))).first()[0] or 0
    width = cells_for(size * EACH_BYTE, CELLS_EACH)
    width = min(width, MOST_CELLS // ROWS)

    def sketch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            # (document's serial number, representative) pairs are distinct, so a count is of documents
            reps = np.concatenate(held)
            cells, count = np.unique(np.concatenate(_places(reps, width)), return_counts=True)
            yield from batches(cells, cells[count > 1])

        kept = 0
        for part in parts:
            for some in pieces(part.column("text")):
                words = WordHashes(some)
                reps = representatives(words.of(), window)
                one, text, _ = _within(words.counts, window)
                reps, text = reps[one], text[one]
                if len(reps):
                    order = np.lexsort((reps, text))
                    reps, text = reps[order], text[order]
                    new = np.ones(len(reps), bool)
                    new[1:] = (reps[1:] != reps[:-1]) | (text[1:] != text[:-1])
                    held.append(reps[new])
                    kept += int(new.sum())
                if kept * ROWS > FLUSH:
                    yield from flush()
                    held, kept = [], 0
        if held:
            yield from flush()

    repeated = spark.sparkContext.broadcast(bitmap(texts.select("text").mapInArrow(sketch, SCHEMA), width * ROWS))
    schema = pa.schema([("h", pa.int64()), ("g", pa.int32()), ("id", pa.int64()), ("mark", pa.int64()), ("place", pa.int64()), ("known", pa.bool_())])

    def likely(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = repeated.value
        held: list[tuple[np.ndarray, ...]] = []
        kept = 0

        def rows(*columns) -> Iterator[pa.RecordBatch]:
            for k in range(0, len(columns[0]), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[k : k + 200_000], t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

        def flush() -> Iterator[pa.RecordBatch]:
            h, g, doc, row, place = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((place, row, doc, g, h))
            h, g, doc, row, place = h[order], g[order], doc[order], row[order], place[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
            first = doc[np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))]
            open_ = doc == first
            yield from rows(signed(h[open_]), g[open_].view(np.int32), doc[open_], row[open_], place[open_] << 32 | 1, np.zeros(int(open_.sum()), bool))
            doc, row, place = doc[~open_], row[~open_], place[~open_]
            if len(doc):
                order = np.lexsort((place, row, doc))
                doc, row, place = doc[order], row[order], place[order]
                start = np.ones(len(doc), bool)
                start[1:] = (doc[1:] != doc[:-1]) | (row[1:] != row[:-1]) | (place[1:] - place[:-1] > 1)
                at = np.flatnonzero(start)
                last = np.append(at[1:], len(doc)) - 1
                spread = signed(mix(doc[at].view(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * place[at].view(np.uint64)))
                yield from rows(spread, np.zeros(len(at), np.int32), doc[at], row[at], place[at] << 32 | (place[last] - place[at] + 1), np.ones(len(at), bool))

        for part in parts:
            docs, marks = np.asarray(part.column("id")), np.asarray(part.column("mark"))
            for some in pieces(part.column("text")):
                own, docs, rows_of, marks = docs[: len(some)], docs[len(some) :], marks[: len(some)], marks[len(some) :]
                words = WordHashes(some)
                lo = words.of()
                reps = representatives(lo, window)
                one, text, place = _within(words.counts, window)
                if not len(reps):
                    continue
                for cells in _places(reps, width):
                    one &= hit(whole, cells)
                at = np.flatnonzero(one)
                if len(at):
                    h = rolling(lo, window)[at]
                    g = rolling(words.of(seed=1), window)[at].astype(np.uint32)
                    held.append((h, g, own[text[at]], rows_of[text[at]], place[at]))
                    kept += len(at)
                if kept > FLUSH // 4:
                    yield from flush()
                    held, kept = [], 0
        if held:
            yield from flush()

    found = texts.mapInArrow(likely, "h long, g int, id long, mark long, place long, known boolean")
    same = Window.partitionBy("h", "g", "known")
    lost = found.withColumn("first", F.min("id").over(same)).where("known or id > first")
    return lost.groupBy("id", "mark").agg(F.collect_list("place").alias("runs"))


def keep_mask(words: int, runs: list[int] | None, window: int) -> np.ndarray:
    """Which of a text's words stay."""
    if not runs:
        return np.ones(words, bool)
    packed = np.array(runs, np.int64)
    start, count = packed >> 32, packed & 0xFFFFFFFF
    edge = np.zeros(words + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, np.minimum(start + count + window - 1, words), -1)
    return np.cumsum(edge[:-1]) == 0


def dedup_substrings(documents: DataFrame, window: int = 13, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """documents with words of repeated windows removed, plus n_words, n_removed and kept_sha256.

    A word goes if a window of consecutive words that covers it also starts in a
    document with a smaller id; windows are judged on the input. Words are
    compared as they are; the kept ones are joined by one space. A null or empty
    text has no words and becomes the empty text; texts shorter than a window
    stay whole. Rows with a null id keep all words; rows that repeat an id count
    as one document when repeats are sought, and each loses its own words. Other columns are passed on unchanged;
    an added column whose name documents already has is left out.
    """
    mine, row, gone_in, words_of, gone_of, digest_of = (fresh(documents, n) for n in ("_match", "_row", "_gone", "_words", "_count", "_digest"))
    mark = row_mark(documents, id_column, text_column)
    lost = covered(documents, window, id_column, text_column, mark).withColumnsRenamed({"id": mine, "mark": row, "runs": gone_in})
    both = documents.join(lost, (F.col(id_column) == F.col(mine)) & (mark == F.col(row)), "left").drop(mine, row)
    names = [c for c in documents.columns if c != text_column]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in documents.schema if f.name != text_column)

    def drop(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts, counts, gone, digests = [], [], [], []
            for text, runs in zip(binaries(part.column(text_column)), part.column(gone_in).to_pylist(), strict=True):
                words = text.split() if text else []
                if runs:
                    stays = keep_mask(len(words), runs, window).tolist()
                    kept = [w for w, s in zip(words, stays, strict=True) if s]
                else:
                    kept = words
                joined = b" ".join(kept)
                texts.append(joined.decode())
                counts.append(len(words))
                gone.append(len(words) - len(kept))
                digests.append(hashlib.sha256(joined).hexdigest())
            made = [pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), *made], names=[*names, text_column, words_of, gone_of, digest_of])

    kept = both.mapInArrow(drop, f"{fields}`{text_column}` string, {words_of} long, {gone_of} long, {digest_of} string")
    added = zip((words_of, gone_of, digest_of), ("n_words", "n_removed", "kept_sha256"), strict=True)
    return kept.select(*documents.columns, *(F.col(c).alias(n) for c, n in added if n not in documents.columns))
