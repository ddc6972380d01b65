"""Count-min sketches of 64-bit hashes, for "how often: once, or more?".

A counter saturates at two, so each row of a sketch is a pair of bitmaps. Partitions fill sketches of their own; those are merged segment by
segment on the executors. An estimate is never below the true count, so what
occurs twice is always reported as repeated, however full the sketch is.

Its size follows the input up to ``MAX_BITS``, which bounds what is broadcast
(depth * 2**MAX_BITS / 8 bytes). Beyond that the sketch only lets more through;
the exact grouping that follows does not depend on it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.columns import batch_of

MIN_BITS, MAX_BITS = 16, 28
SEGMENT_BITS = 22


def bits_for(items: int) -> int:
    """Cells, as a power of two, for about two to four cells an item."""
    return min(MAX_BITS, max(MIN_BITS, math.ceil(math.log2(max(items, 1) * 2))))


def cells(hashes: np.ndarray, depth: int, bits: int) -> np.ndarray:
    """The cell of each hash in one row of a sketch."""
    turned = (hashes >> np.uint64(32)) if depth else hashes
    return (turned & np.uint64((1 << bits) - 1)).astype(np.uint32)


class Sketch:
    """Two bitmaps a row: cells met, and cells met again."""

    def __init__(self, bits: int, depth: int):
        self.bits, self.depth = bits, depth
        self.once = np.zeros((depth, 1 << (bits - 3)), np.uint8)
        self.twice = np.zeros_like(self.once)

    def add(self, hashes: np.ndarray) -> None:
        if not len(hashes):
            return
        for depth in range(self.depth):
            found = np.sort(cells(hashes, depth, self.bits))
            again = found[1:][found[1:] == found[:-1]]
            if len(again):
                at, bits = _bytes_of(again)
                self.twice[depth][at] |= bits
            at, bits = _bytes_of(found)
            self.twice[depth][at] |= self.once[depth][at] & bits
            self.once[depth][at] |= bits

    def segments(self) -> Iterator[tuple[int, bytes, bytes]]:
        """The non-empty segments."""
        width = 1 << (min(SEGMENT_BITS, self.bits) - 3)
        per_row = self.once.shape[1] // width
        for depth in range(self.depth):
            for k in range(per_row):
                part = slice(k * width, (k + 1) * width)
                if self.once[depth, part].any():
                    yield depth * per_row + k, packed(self.once[depth, part]), packed(self.twice[depth, part])


def _bytes_of(sorted_cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that hold sorted cells, each once, and the bits to set there."""
    at = sorted_cells >> np.uint32(3)
    new = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    bits = np.left_shift(1, sorted_cells & np.uint32(7)).astype(np.uint8)
    return at[new], np.bitwise_or.reduceat(bits, new)


def packed(bitmap: np.ndarray) -> bytes:
    """A bitmap, or the gaps between its bits if that is shorter.

    A gap is a byte; 255 stands for 255 cells without a bit.
    """
    at = np.flatnonzero(np.unpackbits(bitmap, bitorder="little"))
    gaps = np.diff(at, prepend=0)
    far = gaps // 255
    if len(at) + int(far.sum()) >= len(bitmap):
        return b"B" + bitmap.tobytes()
    out = np.full(len(at) + int(far.sum()), 255, np.uint8)
    out[np.cumsum(far + 1) - 1] = gaps % 255
    return b"G" + out.tobytes()


def unpacked(payload: bytes, size: int) -> np.ndarray:
    """The bitmap, of ``size`` bytes, that was packed."""
    body = np.frombuffer(payload, np.uint8, offset=1)
    if payload[:1] == b"B":
        return body
    bits = np.zeros(size * 8, np.uint8)
    bits[np.cumsum(body, dtype=np.int64)[body != 255]] = 1
    return np.packbits(bits, bitorder="little")


def _merged(rows: pd.DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    once = twice = np.zeros(size, np.uint8)
    for a, b in zip(rows["once"], rows["twice"], strict=True):
        more = unpacked(a, size)
        once, twice = once | more, twice | unpacked(b, size) | (once & more)
    return once, twice


class Repeated:
    """What a merged sketch says of hashes, in any task: of those met twice, or of all that were met."""

    def __init__(self, sent: Broadcast, bits: int):
        self.sent, self.bits = sent, bits

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """True where a hash may occur as often as asked for; true for each that does."""
        result = np.ones(len(hashes), bool)
        for depth, row in enumerate(self.sent.value):
            at = cells(hashes, depth, self.bits)
            result &= (row[at >> np.uint32(3)] >> (at & np.uint32(7)).astype(np.uint8)) & 1 == 1
        return result


def repeated(docs: DataFrame, hashes_of: Callable[[pa.RecordBatch], Iterable[np.ndarray]], items: int, depth: int = 2, least: int = 2) -> Repeated:
    """Sketch the hashes of all rows of ``docs``; ``items``: about how many there are; ``least``: 2, or 1 for what occurs at all."""
    spark, bits = docs.sparkSession, bits_for(items)
    size = 1 << (min(SEGMENT_BITS, bits) - 3)

    def fill(batches):
        sketch = Sketch(bits, depth)
        for batch in batches:
            for hashes in hashes_of(batch):
                sketch.add(hashes)
        task = TaskContext.get().partitionId()
        for segment, once, twice in sketch.segments():
            yield batch_of(segment=pa.array([segment], pa.int32()), task=pa.array([task], pa.int32()), once=pa.array([once], pa.binary()), twice=pa.array([twice], pa.binary()))

    def some(rows: pd.DataFrame) -> pd.DataFrame:
        once, twice = _merged(rows, size)
        return pd.DataFrame({"segment": [rows["segment"].iloc[0]], "once": [packed(once)], "twice": [packed(twice)]})

    def last(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"segment": [rows["segment"].iloc[0]], "found": [packed(_merged(rows, size)[least - 1])]})

    parts = docs.mapInArrow(fill, "segment int, task int, once binary, twice binary")
    # Groups of about the square root of the number of tasks, merged twice.
    salts = max(1, math.isqrt(docs.rdd.getNumPartitions()))
    first = parts.groupBy("segment", (F.col("task") % salts).alias("salt")).applyInPandas(some, "segment int, once binary, twice binary")
    merged = first.groupBy("segment").applyInPandas(last, "segment int, found binary")
    found = np.zeros((depth, 1 << (bits - 3)), np.uint8)
    flat = found.reshape(-1)
    for row in merged.collect():  # a sketch is bounded by MAX_BITS
        flat[row.segment * size : (row.segment + 1) * size] = unpacked(row.found, size)
    return Repeated(spark.sparkContext.broadcast(found), bits)
