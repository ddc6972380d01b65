"""The words of a piece of documents as one Arrow array of strings.

Equal words get equal codes by Arrow's dictionary of the strings themselves, so
nothing rests on hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from shelfwise.llm.words import LOWER, SPACES

#: Letters of ASCII and every byte of other characters.
LETTERS = np.zeros(256, bool)
LETTERS[ord("A") : ord("Z") + 1] = LETTERS[ord("a") : ord("z") + 1] = LETTERS[0x80:] = True


class WordPiece:
    """Documents of a batch cut into words of bytes other than white space, unchanged.

    ``rows`` are the documents' positions in the batch; ``first[i]`` to ``first[i + 1]``
    are document i's words.
    """

    inside = ~SPACES
    lower = False

    def __init__(self, data: np.ndarray, offsets: np.ndarray, rows: range, lower: bool = False):
        self.rows, self.offsets = rows, offsets
        self.data = LOWER[data] if self.lower else data
        inside = self.inside[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        begins[edges] = inside[edges]  # a document's first byte follows nothing
        starts = np.flatnonzero(begins)
        self.first = np.searchsorted(starts, offsets)
        within = np.cumsum(inside, dtype=np.int64)
        # Where each word begins among the bytes of words alone.
        self.bounds = np.append(within[starts] - 1, within[-1] if len(data) else 0)
        self._kept = self.data[inside]

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def words(self) -> pa.LargeStringArray:
        """All words, in order."""
        return _strings(self.bounds, self._kept)

    def spaced(self) -> pa.LargeBinaryArray:
        """All words, each with a space behind it."""
        at = self.bounds[1:] + np.arange(len(self))
        out = np.empty(len(self._kept) + len(self), np.uint8)
        blank = np.zeros(len(out), bool)
        blank[at] = True
        out[blank], out[~blank] = 0x20, self._kept
        return _strings(self.bounds + np.arange(len(self) + 1), out, pa.large_binary())

    def codes(self) -> tuple[np.ndarray, pa.Array]:
        """A number for each word, equal for equal words, and the words they stand for."""
        encoded = self.words().dictionary_encode()
        return encoded.indices.to_numpy().astype(np.int64), encoded.dictionary


class LetterPiece(WordPiece):
    """The same for runs of letters and characters beyond ASCII, A-Z in lower case."""

    inside = LETTERS
    lower = True


def _strings(bounds: np.ndarray, data: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    buffers = [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(kind or pa.large_string(), len(bounds) - 1, buffers)
