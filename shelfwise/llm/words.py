"""Words of Arrow text columns as arrays of byte positions and 64-bit hashes.

A batch is cut into pieces of whole documents of about ``PIECE_BYTES``, which
bounds the memory of the numpy work whatever the length of a batch; a single
longer document makes a piece of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from shelfwise.llm.kept import release

PIECE_BYTES = 1 << 20

#: Space, and tab to carriage return: what separates words.
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_random = np.random.default_rng(20260101)
BYTE_KEYS = _random.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_to(size: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    up = np.full(size, base, np.uint64)
    down = np.full(size, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(size: int, base: np.uint64 = BASE) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    key = int(base)
    if key not in _POWERS or len(_POWERS[key][0]) < size:
        _POWERS[key] = _powers_to(size + size // 4 + (1 << 16), key)
    up, down = _POWERS[key]
    return up[:size], down[:size]


class Piece:
    """Consecutive documents of a batch: their bytes, words and word hashes.

    ``rows`` are the documents' positions in the batch. ``first[i]`` to
    ``first[i + 1]`` are document i's words; ``starts`` and ``ends`` are byte
    positions in ``data``, which holds A-Z in lower case if asked for.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, rows: range, lower: bool):
        self.rows, self.offsets = rows, offsets
        self.data = LOWER[data] if lower else data
        self._cut(data, offsets)
        self.first = np.searchsorted(self.starts, offsets)

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> None:
        inside = ~SPACES[data]
        before = np.zeros(len(data) + 1, bool)
        before[1:] = inside
        before[offsets] = False  # a document's first byte follows nothing
        after = np.zeros(len(data) + 1, bool)
        after[:-1] = inside
        after[offsets] = False  # its last byte precedes nothing
        self.starts = np.flatnonzero(inside & ~before[:-1])
        self.ends = np.flatnonzero(inside & ~after[1:]) + 1

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        up, down = powers(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(BYTE_KEYS[self.data] * up[: len(self.data)], out=sums[1:])
        return mixed((sums[self.ends] - sums[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(np.uint64))


def pieces(text: pa.Array, lower: bool = False, limit: int = PIECE_BYTES, kind: type[Piece] = Piece) -> Iterator[Piece]:
    """The documents of a text column, in pieces; null texts are empty."""
    if kind is Piece:
        release()
    if text.null_count:
        text = text.fill_null("")
    wide = pa.types.is_large_string(text.type)
    ends = np.frombuffer(text.buffers()[1], np.int64 if wide else np.int32)
    ends = ends[text.offset : text.offset + len(text) + 1].astype(np.int64)
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(text):
        last = max(row + 1, int(np.searchsorted(ends, ends[row] + limit, "right")) - 1)
        part = ends[row : last + 1]
        yield kind(data[part[0] : part[-1]], part - part[0], range(row, last), lower)
        row = last


def window_hashes(words: np.ndarray, width: int, base: np.uint64 = BASE) -> np.ndarray:
    """A hash of each run of ``width`` consecutive values; none if there are fewer."""
    if len(words) < width:
        return np.empty(0, np.uint64)
    up, down = powers(len(words), base)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up, out=sums[1:])
    return mixed((sums[width:] - sums[:-width]) * down[: len(words) - width + 1] + np.uint64(width))
