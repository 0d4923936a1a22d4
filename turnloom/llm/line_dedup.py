"""Line dedup by two Bloom filters (once-seen, twice-seen) and exact confirmation.

Pass 1 builds, in every task, a Bloom filter of the line hashes seen in a
document and one of those seen in two; the filters of all tasks are merged by
segments. Pass 2 looks every line up in the merged twice-seen filter: only
suspected repeats are shuffled, grouped exactly by a 128-bit digest, and the
smallest document of each group keeps its lines. Pass 3 drops the lines.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cells import SCHEMA, batches, bitmap, cells_for, hit
from .common import SPACES, binaries, cut, fresh, mix, row_mark, written

#: Bits a Bloom filter sets for each key, and cells it has for each line.
HASHES, CELLS_EACH = 4, 12
#: Cells a task gathers before it passes them on.
FLUSH = 8_000_000


def line_keys(text: bytes | None, min_chars: int) -> dict[bytes, list[int]]:
    """Keys of at least min_chars code points and the lines that have them."""
    keys: dict[bytes, list[int]] = {}
    for i, line in enumerate(text.lower().split(b"\n") if text else ()):
        key = line.strip(SPACES)
        if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars):
            keys.setdefault(key, []).append(i)
    return keys


def _bits(h: np.ndarray, size: int) -> np.ndarray:
    """HASHES cells for each 64-bit hash."""
    step = mix(h) | np.uint64(1)
    return np.concatenate([((h + np.uint64(j) * step) % np.uint64(size)).astype(np.int64) for j in range(HASHES)])


def suspected_repeats(documents: DataFrame, min_chars: int, id_column: str, text_column: str, mark: Column) -> DataFrame:
    """(digest, id, mark, lines) of every line key that the twice-seen filter holds."""
    spark = documents.sparkSession
    texts = documents.select(F.col(id_column).alias("id"), mark.alias("mark"), F.col(text_column).alias("text"))
    lines = texts.select(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    size = cells_for(lines, CELLS_EACH)

    def filters(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            h, count = np.unique(np.concatenate(held), return_counts=True)
            yield from batches(np.unique(_bits(h, size)), np.unique(_bits(h[count > 1], size)))

        kept = 0
        for part in parts:
            for text in binaries(part.column("text")):
                if keys := line_keys(text, min_chars):
                    held.append(np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys)))
                    kept += len(keys)
                if kept * HASHES > FLUSH:
                    yield from flush()
                    held, kept = [], 0
        if held:
            yield from flush()

    twice = spark.sparkContext.broadcast(bitmap(texts.select("text").mapInArrow(filters, SCHEMA), size))
    schema = pa.schema([("digest", pa.binary()), ("id", pa.int64()), ("mark", pa.int64()), ("lines", pa.list_(pa.int32()))])

    def suspects(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = twice.value
        for part in parts:
            found: tuple[list, list, list, list] = ([], [], [], [])
            for doc, row, text in zip(part.column("id").to_pylist(), part.column("mark").to_pylist(), binaries(part.column("text")), strict=True):
                if doc is None or not (keys := line_keys(text, min_chars)):
                    continue
                h = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
                seen = hit(whole, _bits(h, size)).reshape(HASHES, -1).all(0)
                for known, (key, at) in zip(seen.tolist(), keys.items(), strict=True):
                    if known:
                        for column, value in zip(found, (hashlib.blake2b(key, digest_size=16).digest(), doc, row, at), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, schema.types, strict=True)], schema=schema)

    found = written(texts.mapInArrow(suspects, "digest binary, id long, mark long, lines array<int>"), "line-suspects")
    twice.destroy()  # only the written rows are needed from here on
    return found


def dropped_lines(documents: DataFrame, mark: Column, min_chars: int = 10, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, mark, dropped): the numbers of the lines that each row loses, where it loses any; mark tells rows of one id apart."""
    found = suspected_repeats(documents, min_chars, id_column, text_column, mark)
    # checkpointed, so that both sides of the join are plain and a hot line's rows can be split
    groups = found.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("digest", "first")
    lost = found.join(cut(groups), "digest").where("id > first")
    return lost.groupBy("id", "mark").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("dropped"))


def dedup_lines(documents: DataFrame, min_chars: int = 10, id_column: str = "doc_id", text_column: str = "text", added: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """documents with repeated lines removed from the text, plus the numbers of lines there were and that went.

    A line's key is the line without white space at both ends and with A-Z
    lower-cased. A key of at least min_chars code points found in two or more
    documents stays in the one with the smallest id, where all its lines stay;
    it goes from the others. A null or empty text is one empty line and becomes
    the empty text. Rows with a null id keep all their lines. Rows that repeat
    an id count as one document when repeats are sought, and each loses its own lines. Other columns are passed on unchanged; an
    added column whose name documents already has is left out.
    """
    mine, row, gone, lines_of, gone_of = (fresh(documents, n) for n in ("_match", "_row", "_gone", "_lines", "_count"))
    mark = row_mark(documents, id_column, text_column)
    lost = dropped_lines(documents, mark, min_chars, id_column, text_column).withColumnsRenamed({"id": mine, "mark": row, "dropped": gone})
    both = documents.join(lost, (F.col(id_column) == F.col(mine)) & (mark == F.col(row)), "left").drop(mine, row)
    names = [c for c in documents.columns if c != text_column]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in documents.schema if f.name != text_column)

    def drop(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts, lines, counts = [], [], []
            for text, dropped in zip(binaries(part.column(text_column)), part.column(gone).to_pylist(), strict=True):
                rows = (text or b"").split(b"\n")
                lines.append(len(rows))
                counts.append(len(dropped or ()))
                if dropped:
                    out = set(dropped)
                    rows = [r for i, r in enumerate(rows) if i not in out]
                texts.append(b"\n".join(rows).decode())
            made = [pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), *made], names=[*names, text_column, lines_of, gone_of])

    kept = both.mapInArrow(drop, f"{fields}`{text_column}` string, {lines_of} long, {gone_of} long")
    extra = [F.col(c).alias(n) for c, n in zip((lines_of, gone_of), added, strict=True) if n not in documents.columns]
    return kept.select(*documents.columns, *extra)
