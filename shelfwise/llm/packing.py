"""Packing of documents into training sequences under several limits.

A sequence holds at most ``tokens`` ids, ``segments`` pieces and ``loss`` ids that
bear loss. Whole multiples of the length are cut from long documents; what is left of
each goes to a pool of bounded size. From the pool, the dot-product heuristic for
vector bin packing fills one sequence at a time: of the pieces that fit all limits it
takes the one whose demands, as shares of the limits, have the largest dot product
with what is left. When nothing fits, a piece is cut to fill the rest. A sequence that
a limit closes early gives back its end until its length is a power of two, so no
sequence is padded.

Every task packs its own documents as they stream by: no shuffle, and memory is
bounded by the pool and the longest document. A sequence's id is its task's number
and a count, the same when a task is run again.

Cases: a null or empty text is the end id alone; documents without an id, of equal id
or of equal text are packed each; an empty table has no sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.token_ids import ID, byte_level, encoder

TOKENIZER = "byte_bpe_50k.json"
END_ID = 1
POOL = 2048


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold."""

    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


@dataclass(frozen=True)
class Span:
    """Consecutive ids of one document; ids from ``loss_from`` on bear loss.

    ``ids`` is a view of the document's ids, so cutting copies nothing.
    """

    doc: object
    ids: memoryview
    start: int
    total: int
    loss_from: int

    @property
    def length(self) -> int:
        return len(self.ids) // ID.itemsize

    @property
    def loss(self) -> int:
        return max(0, self.start + self.length - max(self.start, self.loss_from))

    def split(self, length: int) -> tuple[Span, Span]:
        at = length * ID.itemsize
        return replace(self, ids=self.ids[:at]), replace(self, ids=self.ids[at:], start=self.start + length)

    def most(self, tokens: int, loss: int) -> int:
        """How many ids from its start fit these limits."""
        return min(self.length, tokens, max(0, self.loss_from - self.start) + loss)


class Packer:
    """Streams spans in and full sequences out."""

    def __init__(self, limits: Limits, pool: int = POOL):
        self.limits, self.pool = limits, pool
        self.whole = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.spans: list[Span] = []

    def add(self, span: Span) -> Iterator[list[Span]]:
        limits = self.limits
        while span.length >= limits.tokens and span.most(limits.tokens, limits.loss) == limits.tokens:
            first, span = span.split(limits.tokens)
            yield [first]
        if span.length:
            self.spans.append(span)
        if len(self.spans) >= self.pool:
            yield from self._pack(self.pool // 2)

    def finish(self) -> Iterator[list[Span]]:
        yield from self._pack(0)

    def _pack(self, leave: int) -> Iterator[list[Span]]:
        spans = self.spans
        while len(spans) > leave:
            demand = np.array([(s.length, 1, s.loss) for s in spans], float)
            alive = np.ones(len(spans), bool)
            shares = demand / self.whole
            back: list[Span] = []
            # Sequences are built on these arrays until half of the spans are used.
            while alive.sum() > max(leave, len(spans) // 2, 0) or (leave == 0 and alive.any()):
                yield self._one(spans, demand, shares, alive, back)
            self.spans = spans = [s for s, a in zip(spans, alive.tolist(), strict=True) if a] + back

    def _one(self, spans, demand, shares, alive, back) -> list[Span]:
        """One sequence; what it cuts off goes to ``back``."""
        left, taken = self.whole.copy(), []
        while True:
            fits = alive & (demand <= left).all(axis=1)
            if not fits.any():
                break
            best = int(np.argmax(np.where(fits, shares @ (left / self.whole), -1)))
            alive[best] = False
            taken.append(spans[best])
            left -= demand[best]
        if left[0] and left[1]:
            # No piece fits whole: cut one that does not, of what the limits let in.
            for k in np.flatnonzero(alive)[:1]:
                room = spans[k].most(int(left[0]), int(left[2]))
                if room:
                    alive[k] = False
                    head, tail = spans[k].split(room)
                    taken.append(head)
                    if tail.length:
                        back.append(tail)
        length = sum(s.length for s in taken)
        if length < self.limits.tokens:
            self._give_back(taken, length - (1 << (length.bit_length() - 1)), back)
        return taken

    @staticmethod
    def _give_back(taken: list[Span], extra: int, back: list[Span]) -> None:
        while extra:
            span = taken.pop()
            if span.length > extra:
                head, tail = span.split(span.length - extra)
                taken.append(head)
                back.append(tail)
                return
            back.append(span)
            extra -= span.length


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    limits: Limits = Limits(),
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
    loss_column: str | None = None,
    with_ids: bool = False,
    added_tokens: bool = False,
) -> DataFrame:
    """One row per piece: the document's ids from ``start``, and where they stand in which sequence.

    ``loss_column`` holds how many ids of a document come before those that bear loss
    (a prompt's length); without it, or where it is null, that is the first id alone.
    ``with_ids`` adds the ids. ``added_tokens`` gives added tokens in a text their own ids.
    """
    loss_from = F.coalesce(F.col(loss_column).cast("long"), F.lit(1)) if loss_column else F.lit(1).cast("long")
    rows = docs.select(F.col(id_column).cast("long"), F.coalesce(F.col(text_column).cast("string"), F.lit("")), loss_from)

    def sequences(batches):
        encode, packer = encoder(tokenizer_path, byte_level(added_tokens), added_tokens), Packer(limits)
        end = np.array([end_id], ID).tobytes()
        for batch in batches:
            docs, loss = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for row, ids in encode.documents(batch.column(1)):
                yield from packer.add(Span(docs[row], memoryview(ids.tobytes() + end), 0, len(ids) + 1, max(0, loss[row])))
        yield from packer.finish()

    def pieces(batches):
        number = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        for sequence in sequences(batches):
            offset = 0
            for span in sequence:
                rows.append((span.doc, span.start, span.length, zlib.crc32(span.ids), span.total, number, offset, np.frombuffer(span.ids, ID).astype(np.int64) if with_ids else None))
                offset += span.length
            number += 1
            if len(rows) > 4096:
                yield _batch(rows, with_ids)
                rows = []
        yield _batch(rows, with_ids)

    return rows.mapInArrow(pieces, SCHEMA + (", ids array<long>" if with_ids else ""))


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    columns = {name: pa.array([row[k] for row in rows], pa.int64()) for k, name in enumerate(names)}
    if with_ids:
        columns["ids"] = pa.array([row[-1] for row in rows], pa.list_(pa.int64()))
    return pa.RecordBatch.from_pydict(columns)
