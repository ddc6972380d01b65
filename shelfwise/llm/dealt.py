"""How many of a set's hashes no other set has, counted by tasks that each own a part of the cells.

A sketch that every task holds cannot grow with the input for ever. Here nothing is
held whole: the lower half of the hash space is cut into two to four cells a hash, the
cells into segments, and hashes go to the task of their segment, which answers for each
set how many of its cells nothing else has met. A hash that two sets have is never
counted as lone; one that shares its cell by chance is not either.

Hashes travel in chunks, many sets together: for a segment, how many hashes each run of
2**16 cells has, the lower 16 bits of their cells, and the number in the chunk of the
set that each belongs to (four bytes a hash). The number of segments follows the input,
what a segment holds does not; a cell that a whole chunk shares is sent twice.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.llm.columns import batch_of

#: The columns of a chunk's rows. Segment -1 has what names its sets.
SCHEMA = "chunk long, segment int, cells binary, owners binary"
NAMES = -1
#: Hashes and sets of a chunk, about; a set's number in it has 16 bits.
HASHES, SETS = 1 << 21, 1 << 15
RUN_BITS, MOST_BITS, SEGMENTS = 16, 22, 7


class Cells:
    """The cells of the lower half of the hash space, and their segments, for about so many hashes in all."""

    def __init__(self, hashes: int):
        self.bits = max(RUN_BITS + SEGMENTS, math.ceil(math.log2(max(hashes, 1))))
        self.in_segment = min(MOST_BITS, self.bits - SEGMENTS)
        self.runs = 1 << (self.in_segment - RUN_BITS)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """The cells of sorted hashes of a set; those of the upper half have none."""
        return hashes[: np.searchsorted(hashes, np.uint64(1 << 63))] >> np.uint64(63 - self.bits)

    def unpacked(self, payload: bytes) -> np.ndarray:
        """Places in a segment."""
        run = np.frombuffer(payload, np.uint32, self.runs)
        low = np.frombuffer(payload, np.uint16, offset=4 * self.runs)
        return (np.repeat(np.arange(self.runs, dtype=np.uint32), run) << np.uint32(RUN_BITS)) | low


class Chunk:
    """Sets on their way to the segments, with what names each (some 64-bit numbers)."""

    def __init__(self, cells: Cells):
        self.cells, self.keys, self.names, self.hashes = cells, [], [], 0

    def add(self, sets: list[np.ndarray], names: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Take sets of sorted hashes, a row of ``names`` each; give the rows of chunks that are full."""
        for own, name in zip(sets, names, strict=True):
            found = self.cells.of(own)
            self.keys.append(found << np.uint64(16) | np.uint64(len(self.names)))
            self.names.append(name)
            self.hashes += len(found)
            if self.hashes >= HASHES or len(self.names) >= SETS:
                yield from self.rows()

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.names:
            return
        keys = np.sort(np.concatenate(self.keys))
        cell = keys >> np.uint64(16)
        enough = np.ones(len(keys), bool)
        enough[2:] = cell[2:] != cell[:-2]  # two say that none is lone
        cell, owner = cell[enough], keys[enough].astype(np.uint16)
        segments, first = np.unique(cell >> np.uint64(self.cells.in_segment), return_index=True)
        low, run = cell.astype(np.uint16), (cell >> np.uint64(RUN_BITS)) & np.uint64(self.cells.runs - 1)
        segment, cells, owners = [NAMES], [np.array(self.names).tobytes()], [b""]
        for s, a, b in zip(segments.tolist(), first.tolist(), np.append(first, len(cell))[1:].tolist(), strict=True):
            runs = np.bincount(run[a:b].astype(np.int64), minlength=self.cells.runs).astype(np.uint32)
            segment.append(s)
            cells.append(runs.tobytes() + low[a:b].tobytes())
            owners.append(owner[a:b].tobytes())
        chunk = pa.array([uuid.uuid4().int >> 65] * len(segment), pa.int64())
        self.keys, self.names, self.hashes = [], [], 0
        yield batch_of(chunk=chunk, segment=pa.array(segment, pa.int32()), cells=pa.array(cells, pa.binary()), owners=pa.array(owners, pa.binary()))


def mostly_shared(chunks: DataFrame, cells: Cells, columns: list[str], size: str, percent: int) -> DataFrame:
    """The names (``columns``, longs) of sets of which less than ``percent`` cannot be told to be in other sets.

    ``chunks``: the rows that ``Chunk`` gave; they must be the same whenever they are read. ``size``: the column of sets' sizes.
    """

    def lone(rows: pd.DataFrame) -> pd.DataFrame:
        own = [cells.unpacked(x) for x in rows["cells"]]
        met = np.bincount(np.concatenate(own), minlength=1 << cells.in_segment) < 2
        owners = [np.frombuffer(x, np.uint16)[met[at]].tobytes() for x, at in zip(rows["owners"], own, strict=True)]
        return pd.DataFrame({"chunk": rows["chunk"], "segment": rows["segment"], "cells": b"", "owners": owners})

    def named(rows: pd.DataFrame) -> pd.DataFrame:
        names = np.frombuffer(rows.loc[rows["segment"] == NAMES, "cells"].iloc[0], np.int64).reshape(-1, len(columns))
        alone = np.zeros(len(names), np.int64)
        for x in rows["owners"]:
            alone += np.bincount(np.frombuffer(x, np.uint16), minlength=len(names))
        sizes = names[:, columns.index(size)]
        keep = (sizes > 0) & (100 * (sizes - alone) >= percent * sizes)
        return pd.DataFrame(names[keep], columns=columns)

    answers = chunks.where(f"segment <> {NAMES}").groupBy("segment").applyInPandas(lone, SCHEMA)
    both = chunks.where(f"segment = {NAMES}").unionByName(answers)
    return both.groupBy("chunk").applyInPandas(named, ", ".join(f"{c} long" for c in columns))
