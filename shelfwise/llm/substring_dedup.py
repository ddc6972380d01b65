"""Removal of word windows that occur earlier in the corpus.

A window is ``width`` consecutive words. A word goes if it lies in a window whose
word sequence also starts earlier: in a document of smaller id, or before in the
same document. Windows are judged on the input, not on what is left of it.

Method: a count-min prefilter and an exact second pass.

1. Every partition fills a count-min sketch; the sketches are merged. What is
   counted are a window's *marks*: the smallest hash among its runs of
   ``width // 2`` words, once for each place. A window that occurs at two places
   has its mark at two places, so a sketch of marks (about a sixth as many as
   windows) overestimates window counts as well and loses no repeated window.
2. Only windows whose mark may be repeated are grouped, exactly, by a 96-bit hash
   of their words: the smallest document id that has a window owns it. A map-side
   minimum comes first, so a window that a third of all documents share is one
   row a task, and every document sends a window once.
3. Each document gets the hashes it owns (no more than it has words) and drops
   what may be repeated, is not its own, or came earlier in the same document.

Cases: a null text has no words; documents of fewer than ``width`` words keep
them all; equal ids are not earlier than one another, so rows that repeat an id
keep what they share; rows without an id are compared only within themselves;
input columns that have a result column's name are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfwise.llm import words
from shelfwise.llm.columns import batch_of, character_total, ids_and_texts, without
from shelfwise.llm.sketch import repeated

WIDTH = 20
SECOND_BASE = np.uint64(0xD6E8FEB86659FD93)
#: Bytes of text for one mark, roughly: six a word, and a mark every six words.
BYTES_A_MARK = 36
ADDED = ("n_words", "n_removed", "kept_sha256")


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The least or greatest of each run of ``width`` values, by doubling."""
    result, covered = values, 1
    while covered < width:
        step = min(covered, width - covered)
        result = best(result[:-step], result[step:])
        covered += step
    return result


class Windows:
    """The windows of a piece: whether they lie in one document, and their marks."""

    def __init__(self, piece: words.Piece, width: int):
        self.piece, self.width, self.hashes = piece, width, piece.hashes()
        n = len(self.hashes) - width + 1
        self.inside = np.zeros(max(n, 0), bool)
        for a, b in zip(piece.first[:-1], piece.first[1:], strict=True):
            self.inside[a : max(a, b - width + 1)] = True
        if n <= 0:
            self.marks = np.empty(0, np.uint64)
            return
        run = max(1, width // 2)
        self.runs = words.window_hashes(self.hashes, run)
        self.marks = _sliding(self.runs, width - run + 1, np.minimum)

    def marked_places(self) -> np.ndarray:
        """The mark's hash, once for each place at which a window has its mark."""
        if not len(self.marks):
            return self.marks
        span = len(self.runs) - len(self.marks)
        marks = np.where(self.inside, self.marks, np.uint64(0))
        padded = np.concatenate((np.zeros(span, np.uint64), marks, np.zeros(span, np.uint64)))
        return self.runs[self.runs == _sliding(padded, span + 1, np.maximum)]

    def identities(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """96 bits of hash for the windows that start at these words."""
        first = words.window_hashes(self.hashes, self.width)[at].view(np.int64)
        second = words.window_hashes(self.hashes, self.width, SECOND_BASE)[at]
        return first, (second >> np.uint64(33)).astype(np.int32)


def _owned(docs: DataFrame, maybe, width: int) -> DataFrame:
    """For each document that owns any, the first hash word of the windows it owns."""

    def candidates(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            missing = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            for piece in words.pieces(batch.column(1)):
                found = Windows(piece, width)
                at = np.flatnonzero(found.inside)
                at = at[maybe(found.marks[at])]
                doc = np.searchsorted(piece.first, at, "right") - 1 + piece.rows.start
                at, doc = at[~missing[doc]], doc[~missing[doc]]
                if len(at):
                    one, two = found.identities(at)
                    order = np.lexsort((one, doc))
                    one, two, doc = one[order], two[order], doc[order]
                    new = np.concatenate(([True], (one[1:] != one[:-1]) | (doc[1:] != doc[:-1])))
                    yield batch_of(
                        one=pa.array(one[new]),
                        two=pa.array(two[new]),
                        doc_id=pa.array(ids[doc[new]].astype(np.int64)),
                    )

    rows = docs.mapInArrow(candidates, "one long, two int, doc_id long")
    owners = rows.groupBy("one", "two").agg(F.min("doc_id").alias("doc_id"))
    return owners.groupBy("doc_id").agg(F.collect_list("one").alias("owned"))


def _earlier_in_document(identities: np.ndarray) -> np.ndarray:
    """True for each value that was met before."""
    order = np.argsort(identities, kind="stable")
    later = np.zeros(len(identities), bool)
    later[order[1:]] = identities[order[1:]] == identities[order[:-1]]
    return later


def _covered(n_words: int, starts: np.ndarray, width: int) -> np.ndarray:
    change = np.zeros(n_words + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return np.cumsum(change[:-1]) > 0


def _cut(text: bytes, starts: np.ndarray, gone: np.ndarray) -> str:
    """The text without these words and the white space that follows each."""
    until = np.append(starts[1:], len(text))
    parts, at = [], 0
    for k in np.flatnonzero(gone):
        parts.append(text[at : starts[k]])
        at = until[k]
    return b"".join([*parts, text[at:]]).decode()


def remove_repeated_windows(
    docs: DataFrame, width: int = WIDTH, id_column: str = "doc_id", text_column: str = "text", cut_text: bool = True
) -> DataFrame:
    """``docs`` with the words of repeated windows removed from the text.

    Adds n_words and n_removed, and kept_sha256: of the kept words joined by single
    spaces. A text that loses nothing stays as it is. Without ``cut_text`` the text
    is left out.
    """
    pairs = ids_and_texts(docs, id_column, text_column)
    texts = pairs.select("text")

    def marks(batch):
        for piece in words.pieces(batch.column(0)):
            yield Windows(piece, width).marked_places()

    maybe = repeated(texts, marks, 2 * character_total(texts) // BYTES_A_MARK)
    owned = _owned(pairs, maybe, width)
    kept = without(docs, ADDED)
    own_name, key = "owned of this document", "id of this document"
    left = kept.withColumn(key, F.col(id_column).cast("long"))
    joined = left.join(owned.select(F.col("doc_id").alias(key), F.col("owned").alias(own_name)), key, "left")
    out = kept if cut_text else kept.drop(text_column)
    names = out.columns
    schema = StructType(list(out.schema.fields)).add("n_words", "long").add("n_removed", "long").add("kept_sha256", "string")
    passed = [c for c in names if c != text_column]

    def judged(batches):
        for batch in batches:
            ids, owns, texts = batch.column(key), batch.column(own_name), batch.column(text_column).cast(pa.string())
            n_words, n_removed, digests, changed = [], [], [], []
            for piece in words.pieces(texts):
                found = Windows(piece, width)
                raw = piece.data.tobytes()
                possible = found.inside.copy()
                possible[possible] = maybe(found.marks[possible])
                windows = words.window_hashes(found.hashes, width).view(np.int64)
                for k, row in enumerate(piece.rows):
                    a, b = piece.first[k], piece.first[k + 1]
                    text = raw[piece.offsets[k] : piece.offsets[k + 1]]
                    kept_words = text.split()
                    at = a + np.flatnonzero(possible[a : max(a, b - width + 1)])
                    if len(at):
                        value = windows[at]
                        bad = _earlier_in_document(value)
                        if ids[row].is_valid:
                            mine = owns[row].values.to_numpy() if owns[row].is_valid else np.empty(0, np.int64)
                            bad |= ~np.isin(value, mine)
                        at = at[bad]
                    n_words.append(len(kept_words))
                    if len(at):
                        gone = _covered(b - a, at - a, width)
                        n_removed.append(int(gone.sum()))
                        kept_words = [w for w, g in zip(kept_words, gone.tolist(), strict=True) if not g]
                        if cut_text:
                            changed.append(_cut(text, piece.starts[a:b] - piece.offsets[k], gone))
                    else:
                        n_removed.append(0)
                        if cut_text:
                            changed.append(texts[row].as_py())
                    digests.append(hashlib.sha256(b" ".join(kept_words)).hexdigest())
            columns = {c: batch.column(c) for c in passed}
            if cut_text:
                columns[text_column] = pa.array(changed, pa.string())
            made = {"n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(digests, pa.string())}
            yield pa.RecordBatch.from_pydict({c: columns[c] for c in names} | made)

    return joined.mapInArrow(judged, schema)
