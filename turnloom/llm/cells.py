"""Distributed sketches of cells that were hit once, and more than once.

Each task turns the cells that its rows hit into gaps between them, or into
compressed bitmaps where these are smaller, one pair (hit at all, hit at least
twice) for each segment of the sketch. Merging is by
segment: a cell counts as hit twice if one task says so or two tasks hit it.
Only the merged map of cells hit twice is kept; a Bloom filter of twice-seen
keys and a count-min sketch with the threshold two both read it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import written

#: Cells of one segment; its bitmap has an eighth of that in bytes.
SEGMENT = 1 << 22
#: Largest sketch, in cells: its bitmap, which is broadcast, has 256 MB.
MOST_CELLS = 1 << 31

SCHEMA = "segment int, once binary, twice binary"
_ARROW = pa.schema([("segment", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])


def cells_for(keys: float, each: float) -> int:
    """A power of two with about `each` cells for every key, within SEGMENT and MOST_CELLS.

    Beyond the largest size the sketch fills up: more keys are then taken for
    repeated and confirmed exactly, and none is lost.
    """
    wanted = max(1.0, keys * each)
    return int(min(MOST_CELLS, max(SEGMENT, 1 << int(np.ceil(np.log2(wanted))))))


#: First byte of packed cells: gaps of two bytes, or a compressed bitmap.
_GAPS, _BITS = b"g", b"b"


def _packed(cells: np.ndarray) -> bytes:
    """Sorted cells of one segment, at least one."""
    gaps = np.diff(cells, prepend=0)
    if len(cells) * 16 <= SEGMENT and int(gaps.max()) < 1 << 16:
        return _GAPS + gaps.astype("<u2").tobytes()
    dense = np.zeros(SEGMENT, np.uint8)
    dense[cells] = 1
    return _BITS + zlib.compress(np.packbits(dense).tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    """The cells that _packed was given."""
    if packed[:1] == _GAPS:
        return np.cumsum(np.frombuffer(packed, "<u2", offset=1), dtype=np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(packed[1:]), np.uint8)))


def batches(once: np.ndarray, twice: np.ndarray) -> Iterator[pa.RecordBatch]:
    """once, twice: sorted cells; each cell of twice is one of once."""
    at = [np.searchsorted(x, np.arange(0, (int(once[-1]) if len(once) else 0) + SEGMENT + 1, SEGMENT)) for x in (once, twice)]
    for k in range(len(at[0]) - 1):
        a, b = once[at[0][k] : at[0][k + 1]], twice[at[1][k] : at[1][k + 1]]
        if len(a):
            low = k * SEGMENT
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([_packed(a - low)], pa.binary()), pa.array([_packed(b - low) if len(b) else None], pa.binary())], schema=_ARROW
            )


def merged(df: DataFrame) -> DataFrame:
    """(segment, bitmap) of the cells hit at least twice; one row for each segment."""

    def merge(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = np.zeros(SEGMENT, bool)
        twice = np.zeros(SEGMENT, bool)
        for part in parts:
            for a, b in zip(part.column("once"), part.column("twice"), strict=True):
                cells = _unpacked(a.as_py())
                twice[cells[once[cells]]] = True
                once[cells] = True
                if b.is_valid:
                    twice[_unpacked(b.as_py())] = True
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([zlib.compress(np.packbits(twice).tobytes(), 1)], pa.binary())], names=["segment", "bitmap"])

    return df.groupBy("segment").applyInArrow(merge, "segment int, bitmap binary")


def bitmap(df: DataFrame, cells: int) -> np.ndarray:
    """The whole merged map; bounded by MOST_CELLS, whatever the input."""
    whole = np.zeros(cells // 8, np.uint8)
    # written first, so that segments are merged in parallel and not one after another
    for row in written(merged(df), "cells").toLocalIterator():
        low = row.segment * (SEGMENT // 8)
        whole[low : low + SEGMENT // 8] = np.frombuffer(zlib.decompress(row.bitmap), np.uint8)
    return whole


def hit(whole: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Whether each cell is set in the map."""
    return (whole[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1
