"""Benchmark items found in documents, by SimHash of item-sized windows and a multi-index.

Words are runs without white space, A-Z in lower case. Window sizes come in groups, a fifth
apart; an item of n words belongs to the largest group whose window and stride fit into it, so
its windows hold most of its words. A window has a 64-bit SimHash of its words,
weighted by length. The item's windows are filed at all its places, the documents' are
taken every ``stride`` words: of any unchanged copy one window falls on a filed place.

A fingerprint has four blocks of 16 bits. If two differ in at most ``RADIUS`` = 7
bits, some block differs in at most one, so each item fingerprint is filed under the
17 values near each of its blocks, and looking up a window's four blocks finds every
item fingerprint within the radius. Around each candidate line every stretch of the item's
length that starts within ``SLACK`` of it is verified exactly: the sets of five-word shingles of
item and stretch, shingles weighted by their letters, must have a weighted Jaccard
similarity of ``SIMILARITY`` or more. The radius is about what similar stretches differ in;
in the tests, with copies edited up to what the similarity allows, it finds over nine tenths.

The rest is the share of a supplement, which ``supplement=False`` leaves out: an item is also
looked for by anchors, shingles of its own, rare among the items and heavy first, so
many that a stretch without any of them cannot be similar enough. Around each anchor
in a document every stretch of the item's length is weighed, so no match is lost.

Items go in blocks of ``BLOCK_ITEMS`` items or ``BLOCK_CHARACTERS``, each broadcast (a bounded
size) and held against all documents, so a larger benchmark takes more passes and no more memory.

Cases: null and empty texts match nothing; items of fewer than five words have no
shingle and are skipped; equal items are each reported; a document's matches with an
item are one row, with the best similarity and its first place; documents without an
id are matched too.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import words
from shelfwise.llm.columns import batch_of, ids_and_texts

WIDTH = 5
SIMILARITY = 0.8
RADIUS = 7
BLOCKS, BLOCK_BITS = 4, 16
SLACK = 0.12  # of an item's words: how far a similar stretch may start from where a window lines it up
BLOCK_ITEMS, BLOCK_CHARACTERS = 4096, 1 << 23
MOST_WEIGHT = 8
ANCHOR_BITS = 20


def stride(size: int) -> int:
    return max(1, size // 5)


def group_of(n_words: int) -> int:
    """The window size of an item: the largest group whose window and stride fit into it."""
    size = WIDTH
    while (larger := max(size + 1, size * 6 // 5)) + stride(larger) - 1 <= n_words:
        size = larger
    return size


def fingerprints(hashes: np.ndarray, lengths: np.ndarray, steps: dict[int, int]) -> dict[int, np.ndarray]:
    """The SimHash of the windows of each size, every so many words.

    Bits are taken one by one, so that a bit's sums over all words stay in the processor's
    cache for all sizes. Sums may wrap around; their differences over a window are right
    all the same.
    """
    n = len(hashes)
    kind = np.int16 if max(steps) * MOST_WEIGHT < 1 << 15 else np.int32
    planes = np.unpackbits(np.ascontiguousarray(hashes.view(np.uint8).reshape(n, 8).T), axis=0).view(np.int8)
    weight, sums = np.minimum(lengths, MOST_WEIGHT).astype(np.int8), np.zeros(n + 1, kind)
    packed = {size: np.zeros((8, len(range(0, n + 1 - size, step))), np.uint8) for size, step in steps.items()}
    for bit, plane in enumerate(planes):
        np.cumsum((plane * 2 - 1) * weight, dtype=kind, out=sums[1:])
        for size, step in steps.items():
            above = sums[size::step] - sums[: max(n + 1 - size, 0) : step] > 0
            packed[size][bit // 8] |= above.view(np.uint8) << np.uint8(7 - bit % 8)
    return {size: np.ascontiguousarray(rows.T).view(np.uint64).reshape(-1) for size, rows in packed.items()}


def _weights(lengths: np.ndarray) -> np.ndarray:
    """The letters of each shingle."""
    return np.convolve(lengths, np.ones(WIDTH, np.int64), "valid") if len(lengths) >= WIDTH else np.empty(0, np.int64)


class Item:
    """A benchmark item's shingles and their weights."""

    def __init__(self, item_id: int, hashes: np.ndarray, lengths: np.ndarray):
        self.item_id, self.size = item_id, len(hashes)
        shingles, at = np.unique(words.window_hashes(hashes, WIDTH), return_index=True)
        self.weight = dict(zip(shingles.tolist(), _weights(lengths)[at].tolist(), strict=True))
        self.total = sum(self.weight.values())

    def anchors(self, holders: Counter) -> list[int]:
        """Shingles of which a similar stretch has one: what lacks them all is too light."""
        chosen, left = [], self.total
        for shingle in sorted(self.weight, key=lambda s: (holders[s], -self.weight[s], s)):
            if left / self.total < SIMILARITY:
                break
            chosen.append(shingle)
            left -= self.weight[shingle]
        return chosen

    def best(self, shingles: np.ndarray, weights: np.ndarray, first: int, last: int, begin: int, end: int) -> tuple[float, int]:
        """The best similarity of stretches that start at ``first`` to ``last``, and the first such start.

        A stretch has the item's length, cut at the document's words ``begin`` to ``end``. Each
        shingle counts once a stretch: for the starts after its last place up to its own.
        """
        low, high = max(first, begin), min(last + self.size, end) - WIDTH + 1
        own, at = shingles[low:high], np.arange(low, high)
        order = np.argsort(own, kind="stable")
        again = own[order][1:] == own[order][:-1]
        since = at + WIDTH - self.size
        since[order[1:][again]] = np.maximum(since[order[1:][again]], at[order[:-1][again]] + 1)
        since, until = np.maximum(since, first) - first, np.minimum(at, last) + 1 - first
        shared = np.fromiter((s in self.weight for s in own.tolist()), bool, len(own))
        sums = []
        for weight in (weights[low:high], weights[low:high] * shared):
            held = (weight * (since < until)).astype(float)
            n = last - first + 2
            sums.append(np.cumsum(np.bincount(np.minimum(since, until), held, n) - np.bincount(until, held, n))[:-1])
        found, both = sums
        similarity = both / (self.total + found - both)
        k = int(np.argmax(similarity))
        return float(similarity[k]), first + k


class Index:
    """Items and their fingerprints, filed by block values."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.items: list[Item] = []
        filed: dict[int, list[tuple[int, int, int]]] = {}  # size: (fingerprint, item, place)
        for item_id, text in rows:
            piece = next(words.pieces(pa.array([text]), lower=True))
            hashes, lengths = piece.hashes(), piece.ends - piece.starts
            if len(hashes) < WIDTH:
                continue
            size = group_of(len(hashes))
            made = fingerprints(hashes, lengths, {size: 1})[size]
            filed.setdefault(size, []).extend((mark, len(self.items), place) for place, mark in enumerate(made.tolist()))
            self.items.append(Item(item_id, hashes, lengths))
        self.sizes = np.array([item.size for item in self.items], np.int64)
        self.by_size = {size: self._filed(entries) for size, entries in sorted(filed.items())}
        holders = Counter(s for item in self.items for s in item.weight)
        anchors = [(s, k) for k, item in enumerate(self.items) for s in item.anchors(holders)]
        order = np.argsort(np.array([s for s, _ in anchors], np.uint64), kind="stable")
        self.anchors = np.array([s for s, _ in anchors], np.uint64)[order]  # sorted, with the item of each
        self.anchored = np.array([k for _, k in anchors], np.int64)[order]
        self.maybe = np.zeros(1 << ANCHOR_BITS, bool)
        self.maybe[self.anchors >> np.uint64(64 - ANCHOR_BITS)] = True

    @staticmethod
    def _filed(entries: list[tuple[int, int, int]]):
        marks = np.array([e[0] for e in entries], np.uint64)
        item, place = (np.array([e[k] for e in entries], np.int64) for k in (1, 2))
        near = np.array([0, *(1 << b for b in range(BLOCK_BITS))], np.uint64)
        blocks = []
        for b in range(BLOCKS):
            value = ((marks >> np.uint64(b * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1))[:, None] ^ near
            order = np.argsort(value.reshape(-1), kind="stable")
            first = np.zeros((1 << BLOCK_BITS) + 1, np.int64)
            np.cumsum(np.bincount(value.reshape(-1).astype(np.int64), minlength=1 << BLOCK_BITS), out=first[1:])
            blocks.append((first, order // len(near)))
        return marks, item, place, blocks

    def candidates(self, size: int, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows and entries whose fingerprints differ in at most RADIUS bits."""
        marks, _, _, blocks = self.by_size[size]
        at, entry = [], []
        for b, (first, filed) in enumerate(blocks):
            value = ((windows >> np.uint64(b * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)
            count = first[value + 1] - first[value]
            hit = np.flatnonzero(count)
            many = count[hit]
            window = np.repeat(hit, many)
            within = np.arange(len(window)) - np.repeat(np.cumsum(many) - many, many)
            found = filed[np.repeat(first[value[hit]], many) + within]
            close = np.bitwise_count(windows[window] ^ marks[found]) <= RADIUS
            at.append(window[close])
            entry.append(found[close])
        return np.concatenate(at), np.concatenate(entry)

    def _runs(self, doc: np.ndarray, item: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, first start, last start) of spans of starts, those that touch put together."""
        order = np.lexsort((first, item, doc))
        run: list[int] = []
        for d, i, a, b in zip(*(x[order].tolist() for x in (doc, item, first, last)), strict=True):
            if run and run[:2] == [d, i] and a <= run[3] + 1:
                run[3] = max(run[3], b)
                continue
            if run:
                yield tuple(run)
            run = [d, i, a, b]
        if run:
            yield tuple(run)

    def around_windows(self, hashes: np.ndarray, lengths: np.ndarray, doc_of: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Runs of starts near the lines of windows whose fingerprints are within the radius of an item's."""
        steps, found = {size: stride(size) for size in self.by_size}, []
        for size, windows in fingerprints(hashes, lengths, steps).items():
            at = np.arange(len(windows)) * steps[size]
            inside = np.flatnonzero(doc_of[at] == doc_of[at + size - 1])
            window, entry = self.candidates(size, windows[inside])
            _, item, place, _ = self.by_size[size]
            at = at[inside[window]]
            found.append(np.column_stack([doc_of[at], item[entry], at - place[entry]]))
        doc, item, start = np.unique(np.concatenate(found), axis=0).T
        slack = (self.sizes[item] * SLACK).astype(np.int64) + 1
        return self._runs(doc, item, start - slack, start + slack)

    def around_anchors(self, shingles: np.ndarray, doc_of: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Runs of starts of stretches that hold an anchor of the item."""
        at = np.flatnonzero(self.maybe[shingles >> np.uint64(64 - ANCHOR_BITS)])
        at = at[doc_of[at] == doc_of[at + WIDTH - 1]]
        low, high = (np.searchsorted(self.anchors, shingles[at], side) for side in ("left", "right"))
        many = high - low
        at = np.repeat(at, many)
        item = self.anchored[np.repeat(low, many) + np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)]
        return self._runs(doc_of[at], item, at + WIDTH - self.sizes[item], at)

    def matches(self, texts: pa.Array, supplement: bool = True) -> Iterator[tuple[int, int, float, int]]:
        """(row, item id, similarity, first word) for each item found in each text."""
        if not self.items:
            return
        for piece in words.pieces(texts, lower=True):
            hashes, lengths = piece.hashes(), piece.ends - piece.starts
            if not len(hashes):
                continue
            doc_of = np.repeat(np.arange(len(piece.rows)), np.diff(piece.first))
            shingles, weights = words.window_hashes(hashes, WIDTH), _weights(lengths)
            runs = list(self.around_windows(hashes, lengths, doc_of))
            if supplement:
                runs += self.around_anchors(shingles, doc_of)
            best: dict[tuple[int, int], tuple[float, int]] = {}
            for doc, item, first, last in runs:
                begin, end = int(piece.first[doc]), int(piece.first[doc + 1])
                first, last = max(first, begin + WIDTH - self.items[item].size), min(last, end - WIDTH)
                if first > last:
                    continue
                similarity, start = self.items[item].best(shingles, weights, first, last, begin, end)
                place = max(start - begin, 0)
                known, where = best.get((doc, item), (0.0, 0))
                if similarity >= SIMILARITY and (similarity > known or (similarity == known and place < where)):
                    best[doc, item] = similarity, place
            for (doc, item), (similarity, word) in best.items():
                yield piece.rows[doc], self.items[item].item_id, similarity, word


def _indexes(benchmark: DataFrame, id_column: str, text_column: str) -> Iterator:
    """The items in broadcast blocks of bounded size, in the order of their ids."""
    items = benchmark.select(F.col(id_column).cast("long").alias("item_id"), F.col(text_column).cast("string").alias("text"))
    items = items.where("item_id is not null and text is not null").orderBy("item_id", "text")
    block: list[tuple[int, str]] = []
    context = benchmark.sparkSession.sparkContext
    characters = 0
    for row in items.toLocalIterator():
        block.append((row.item_id, row.text))
        characters += len(row.text)
        if len(block) == BLOCK_ITEMS or characters >= BLOCK_CHARACTERS:
            yield context.broadcast(Index(block))
            block, characters = [], 0
    if block:
        yield context.broadcast(Index(block))


def contaminated(docs: DataFrame, benchmark: DataFrame, supplement: bool = True) -> DataFrame:
    """(doc_id, item_id, similarity, first_word) for each document that holds an item.

    Without ``supplement`` fingerprints alone name the stretches that are verified.
    """
    pairs = ids_and_texts(docs)
    empty = pairs.sparkSession.createDataFrame([], "doc_id long, item_id long, similarity double, first_word long")

    def rows_of(index):
        def rows(batches):
            for batch in batches:
                found = list(index.value.matches(batch.column(1), supplement))
                row, item, similarity, word = zip(*found, strict=True) if found else ((), (), (), ())
                yield batch_of(
                    doc_id=batch.column(0).take(pa.array(row, pa.int64())),
                    item_id=pa.array(item, pa.int64()),
                    similarity=pa.array(similarity, pa.float64()),
                    first_word=pa.array(word, pa.int64()),
                )

        return rows

    found = empty
    for index in _indexes(benchmark, "item_id", "text"):
        found = found.unionAll(pairs.mapInArrow(rows_of(index), empty.schema))
    best = F.max(F.struct("similarity", (-F.col("first_word")).alias("back"))).alias("best")
    found = found.groupBy("doc_id", "item_id").agg(best)
    return found.select("doc_id", "item_id", "best.similarity", (-F.col("best.back")).alias("first_word"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark item."""

    def rows_of(index):
        def rows(batches):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[row for row, *_ in index.value.matches(batch.column(text_column).cast(pa.string()))]] = False
                yield batch.filter(pa.array(keep))

        return rows

    for index in _indexes(benchmark, "item_id", "text"):
        docs = docs.mapInArrow(rows_of(index), docs.schema)
    return docs
