"""Token ids of whole texts by public tokenizers, each part of a text encoded once.

Both tokenizers cut a text into pre-tokens before they merge, so a text may be cut
wherever a pre-token surely begins and the parts encoded on their own. Parts repeat:
numpy finds the different ones of a piece of text, by a 64-bit hash, the tokenizer
encodes those that a worker has not met, and the ids of all are put together from
what it keeps (``KEPT_PARTS`` at most; then it starts anew). Plain parts, a Latin word
with signs after it, are one or two pre-tokens: those go to the tokenizer's model as
they are; all others through the whole tokenizer.

A tokenizer's added tokens (``<|endoftext|>``) are text like any other, unless
``added_tokens`` is set: then they get their own ids, as the library's plain call gives.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from shelfwise.llm import words
from shelfwise.llm.kept import kept

ID = np.dtype("<u4")
KEPT_PARTS = 1_500_000
PIECE_BYTES = 1 << 20

#: A word of Latin letters, which are their own normal form, and signs; no apostrophe, digit or white space.
PLAIN = re.compile("( ?[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u024F]+)([!-&(-/:-@\\[-`{-~]*)")

#: A space begins a part before these bytes: no white space, and no first byte of a wide white space.
BEGINS = np.ones(256, bool)
BEGINS[:0x21] = False
BEGINS[[0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = False

#: An added token, and how many characters it has at most; the space before one ends the text to its left.
ADDED, LONGEST_ADDED = re.compile(r"<\|[a-z]{1,11}\|>"), 15
SPACE_BEFORE_ADDED = re.compile(rb" (?=<\|[a-z]{1,11}\|>)")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it shows, else the next from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


BYTE_LETTERS = _byte_letters()


class ByteLevelParts(words.Piece):
    """Parts for byte-level BPE: a space before a non-space begins one.

    A pre-token holds at most one space, at its start, unless it is white space
    only; and such a run leaves its last space to the word that follows.
    """

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> None:
        begins = np.zeros(len(data) + 1, bool)
        begins[: max(len(data) - 1, 0)] = (data[:-1] == 0x20) & BEGINS[data[1:]]
        begins[self._unsure(data)] = False
        begins[offsets - 1] = False  # a text's last byte precedes nothing
        begins[offsets] = True
        self.starts = np.flatnonzero(begins[:-1])
        self.ends = np.append(self.starts[1:], len(data))

    def _unsure(self, data: np.ndarray) -> list[int]:
        """Spaces that begin no part."""
        return []

    @staticmethod
    def normal(word: str) -> str:
        return word


class AddedParts(ByteLevelParts):
    """Parts for byte-level BPE whose added tokens count: they stay in one part with the space before them."""

    def _unsure(self, data: np.ndarray) -> list[int]:
        return [found.start() for found in SPACE_BEFORE_ADDED.finditer(data.tobytes())]


class WordParts(words.Piece):
    """Parts for a tokenizer that drops white space: what ASCII white space separates."""

    @staticmethod
    def normal(word: str) -> str:
        return word.lower()


class Encoder:
    """The ids of texts, piece by piece."""

    def __init__(self, path: str, kind: type[words.Piece], added_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens
        for token in self.tokenizer.get_added_tokens_decoder().values():
            if added_tokens and (not ADDED.fullmatch(token.content) or token.lstrip or token.rstrip or token.single_word or token.normalized):
                raise ValueError(f"parts may cut the added token {token.content!r}")
        self.kind = kind
        self._forget()

    def _forget(self) -> None:
        self.keys, self.slots = np.empty(0, np.uint64), np.empty(0, np.int32)  # sorted by key
        self.ids, self.n_ids = np.empty(1 << 16, ID), 0
        self.begin, self.size = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)

    def _encoded(self, part: bytes) -> list[int]:
        text = part.decode()
        plain = PLAIN.fullmatch(text)
        if not plain:
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        word, signs = plain.groups()
        model = self.tokenizer.model.tokenize
        letters = self.kind.normal(word).encode().decode("latin-1").translate(BYTE_LETTERS)
        ids = [token.id for token in model(letters)]
        return ids + [token.id for token in model(signs)] if signs else ids

    def _learn(self, keys: np.ndarray, parts: list[bytes]) -> None:
        made = [self._encoded(part) for part in parts]
        sizes = np.array([len(m) for m in made], np.int64)
        first, total = len(self.keys), self.n_ids + int(sizes.sum())
        if total > len(self.ids):
            self.ids = np.resize(self.ids, total + total // 2)
        if first + len(keys) > len(self.begin):
            room = first + len(keys) + (first + len(keys)) // 2
            self.begin, self.size = np.resize(self.begin, room), np.resize(self.size, room)
        self.ids[self.n_ids : total] = np.concatenate(made)
        self.begin[first : first + len(keys)] = self.n_ids + np.cumsum(sizes) - sizes
        self.size[first : first + len(keys)] = sizes
        self.n_ids = total
        both = np.concatenate((self.keys, keys))
        order = np.argsort(both, kind="stable")
        self.keys = both[order]
        self.slots = np.concatenate((self.slots, np.arange(first, first + len(keys), dtype=np.int32)))[order]

    def _slots(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of these parts are kept, and whether they are."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int32), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.slots[at], self.keys[at] == keys

    def piece_ids(self, piece: words.Piece) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a piece, and how many each part has."""
        if not len(piece.starts):
            return np.empty(0, ID), np.empty(0, np.int64)
        if len(self.keys) > KEPT_PARTS:
            self._forget()
        code, keys = pd.factorize(piece.hashes())
        slots, met = self._slots(keys)
        new = np.flatnonzero(~met)
        if len(new):
            new = new[np.argsort(keys[new])]
            place = np.empty(len(keys), np.int64)
            place[code[::-1]] = np.arange(len(code) - 1, -1, -1)
            raw, at = piece.data.tobytes(), place[new]
            texts = [raw[a:b] for a, b in zip(piece.starts[at].tolist(), piece.ends[at].tolist(), strict=True)]
            self._learn(keys[new], texts)
            slots, _ = self._slots(keys)
        slot = slots[code]
        size = self.size[slot]
        before = np.cumsum(size) - size
        return self.ids[np.repeat(self.begin[slot] - before, size) + np.arange(int(size.sum()))], size

    def documents(self, text: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids) of each text."""
        for piece in words.pieces(text, limit=PIECE_BYTES, kind=self.kind):
            ids, size = self.piece_ids(piece)
            ends = np.concatenate(([0], np.cumsum(size)))[piece.first].tolist()
            for k, row in enumerate(piece.rows):
                yield row, ids[ends[k] : ends[k + 1]]

    def counts(self, text: pa.Array) -> list[int]:
        """How many ids each text has."""
        return [len(ids) for _, ids in self.documents(text)]

    def count(self, text: str) -> int:
        """How many ids one text has."""
        return self.counts(pa.array([text], pa.string()))[0]


def byte_level(added_tokens: bool) -> type[ByteLevelParts]:
    """How texts are cut for byte-level BPE."""
    return AddedParts if added_tokens else ByteLevelParts


def encoder(path: str, kind: type[words.Piece], added_tokens: bool = False) -> Encoder:
    """A worker's encoder."""
    return kept((path, kind, added_tokens), lambda: Encoder(path, kind, added_tokens))
