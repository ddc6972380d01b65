"""Periodic runs of words in documents, by block convolution.

A run is a stretch of words with smallest period q (words q apart are equal) of at least
``MIN_COPIES`` * q and ``MIN_WORDS`` words that no neighbouring word extends.

Method. At each dyadic scale L the words of many documents, as one array of codes with a
code of its own between documents, are cut into blocks of L. A run of a period q from L to
2L - 1 holds an aligned block whose next copy lies q words on. For each block, the sum of
squared differences to every place from L to 2L - 1 words on is
sum(window^2) - 2 * sum(window * block) + sum(block^2), whose middle part is a correlation
by an exact integer transform (``number_transform``). Where the sum is zero the block occurs
again: the distance is the seed of a run, which is extended word by word to both ends. Sums
are modulo a prime, so no occurrence is missed, and the extension compares the words
themselves, so none is made up. A block with a word that does not return within 2L - 1 words
has no occurrence there and is left out beforehand.

Scales ascend, so runs of shorter periods are known: a copy that lies within such a run at a
multiple of its period is that run again, and every other seed of enough length is a run of
smallest period (two periods of a long enough stretch have their greatest common divisor as
a period too).

Documents are worked on where they are read, without a shuffle, a megabyte at a time; a
longer one is a piece of its own, with about a hundred bytes a word.

Cases: null, empty and blank texts have no runs and an empty collapsed text; repeated rows
and ids are judged row by row; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.columns import batch_of, ids_and_texts
from shelfwise.llm.number_transform import PRIME, correlation
from shelfwise.llm.word_arrays import WordPiece
from shelfwise.llm.words import pieces

MIN_COPIES, MIN_WORDS = 4, 6
#: Values of one transform at a time.
AT_ONCE = 1 << 19
SPACE_RUNS = "[\\x20\\x09-\\x0D]+"
_P = np.uint64(PRIME)


class _Codes:
    """Word codes of documents with a code of its own after each, and padding behind."""

    def __init__(self, codes: np.ndarray, first: np.ndarray):
        lengths = np.diff(first)
        self.begin = first[:-1] + np.arange(len(lengths))
        self.end = self.begin + lengths
        self.longest = int(lengths.max(initial=0))
        size = len(codes) + len(lengths)
        self.codes = np.empty(size + 2 * self.longest + 2, np.int64)
        document = np.repeat(np.arange(len(lengths)), lengths + 1)
        self.document = document
        inside = np.ones(size, bool)
        inside[self.end] = False
        kinds = int(codes.max(initial=-1)) + 1
        self.codes[:size][inside] = codes
        self.codes[self.end] = kinds + np.arange(len(lengths))
        self.codes[size:] = kinds + len(lengths)
        self.size = size
        # How far on the same word comes next.
        order = np.argsort(self.codes[:size], kind="stable")
        same = self.codes[order[1:]] == self.codes[order[:-1]]
        self.ahead = np.full(size, np.iinfo(np.int64).max)
        self.ahead[order[:-1][same]] = (order[1:] - order[:-1])[same]
        self.squares = np.concatenate(([0], np.cumsum(self.codes * self.codes % PRIME)))

    def blocks(self, length: int) -> np.ndarray:
        """Where the aligned blocks begin whose words all return soon enough, in documents that are long enough."""
        count = self.size // length
        starts = np.arange(count) * length
        returns = self.ahead[: count * length].reshape(count, length).max(axis=1) < 2 * length
        starts = starts[returns]
        end = self.end[self.document[starts]]
        long_enough = end - self.begin[self.document[starts]] >= MIN_COPIES * length
        return starts[long_enough & (starts + 2 * length <= end)]

    def seeds(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(block start, distance) of every zero sum of squared differences, by distance, then start."""
        starts, found = self.blocks(length), []
        at_once = max(1, AT_ONCE // (2 * length))
        for k in range(0, len(starts), at_once):
            own = starts[k : k + at_once]
            block = self.codes[own + np.arange(length)[:, None]].astype(np.uint64)
            window = self.codes[own + length + np.arange(2 * length)[:, None]].astype(np.uint64)
            cross = correlation(window, block)[:length].astype(np.int64)
            at = own + length + np.arange(length)[:, None]
            ahead = (self.squares[at + length] - self.squares[at]) % PRIME
            here = (self.squares[own + length] - self.squares[own]) % PRIME
            shift, column = np.nonzero((ahead + here - 2 * cross) % PRIME == 0)
            found.append((own[column], length + shift))
        if not found:
            return starts, starts
        start, distance = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((start, distance))
        return start[order], distance[order]

    def extended(self, start: int, length: int, distance: int) -> tuple[int, int]:
        """The longest stretch around a block whose words are equal ``distance`` apart; empty if the block's are not."""
        codes = self.codes
        if not np.array_equal(codes[start : start + length], codes[start + distance : start + distance + length]):
            return start, start
        document = self.document[start]
        low, high = start, start + length
        step, last = 16, self.end[document] - distance
        while high < last:
            stop = min(high + step, last)
            differ = np.flatnonzero(codes[high:stop] != codes[high + distance : stop + distance])
            if len(differ):
                high += int(differ[0])
                break
            high, step = stop, step * 2
        step, least = 16, self.begin[document]
        while low > least:
            stop = max(low - step, least)
            differ = np.flatnonzero(codes[stop:low] != codes[stop + distance : low + distance])
            if len(differ):
                low = stop + int(differ[-1]) + 1
                break
            low, step = stop, step * 2
        return low, int(high) + distance


def _unexplained(start: np.ndarray, distance: np.ndarray, length: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which seeds do not repeat within a known run at a multiple of its period."""
    open_ = np.ones(len(start), bool)
    order = np.argsort(start, kind="stable")
    sorted_start = start[order]
    for low, high, period in runs:
        if high - low < 2 * length:
            continue
        a, b = np.searchsorted(sorted_start, (low, high))
        own = order[a:b]
        open_[own[(start[own] + distance[own] + length <= high) & (distance[own] % period == 0)]] = False
    return open_


def maximal_runs(codes: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(document, start, length, period) of every run, in order; ``first`` has where each document begins, and the end."""
    if not len(codes):
        return []
    words, runs, length = _Codes(codes, first), [], 1
    while MIN_COPIES * length <= words.longest:
        start, distance = words.seeds(length)
        if len(start):
            open_ = _unexplained(start, distance, length, runs)
            at, high = 0, 0
            for s, d in zip(start[open_].tolist(), distance[open_].tolist(), strict=True):
                if d == at and s + d + length <= high:
                    continue  # within the stretch that was extended last
                low, high = words.extended(s, length, d)
                at = d
                if high - low >= max(MIN_WORDS, MIN_COPIES * d):
                    runs.append((low, high, d))
        length *= 2
    found = [(int(words.document[low]), low, high, q) for low, high, q in runs]
    return sorted((k, int(low - words.begin[k]), high - low, q) for k, low, high, q in found)


def _collapsed(piece: WordPiece, runs: list[tuple[int, int, int, int]]) -> pa.Array:
    """Each document's words outside runs or in a run's first period, joined by a space."""
    change = np.zeros(len(piece) + 1, np.int64)
    for document, start, length, period in runs:
        change[piece.first[document] + start + period] += 1
        change[piece.first[document] + start + length] -= 1
    keep = np.cumsum(change[:-1]) == 0
    kept = piece.spaced().filter(pa.array(keep))
    ends = np.concatenate(([0], np.cumsum(keep)))[piece.first]
    bounds = np.frombuffer(kept.buffers()[1], np.int64)[kept.offset :][: len(kept) + 1] if len(kept) else np.zeros(1, np.int64)
    data = memoryview(kept.buffers()[2]) if len(kept) else b""
    at = bounds[ends].tolist()
    return pa.array([bytes(data[a : max(a, b - 1)]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()).cast(pa.string())


RUN = "struct<start:bigint,length:bigint,period:bigint>"


def _run_lists(runs: list[tuple[int, int, int, int]], documents: int) -> pa.Array:
    table = np.array(runs, np.int64).reshape(-1, 4)
    ends = np.searchsorted(table[:, 0], np.arange(documents + 1))
    fields = [pa.array(table[:, k]) for k in (1, 2, 3)]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length, period, by start, then period) and collapsed text of each row.

    A word is left out of the collapsed text if any run holds it after that run's first
    period; the others are joined by one space.
    """

    def rows(batches):
        for batch in batches:
            for piece in pieces(batch.column(1), kind=WordPiece):
                runs = maximal_runs(piece.codes()[0], piece.first)
                yield batch_of(
                    doc_id=batch.column(0).slice(piece.rows.start, len(piece.rows)),
                    n_words=pa.array(np.diff(piece.first), pa.int64()),
                    runs=_run_lists(runs, len(piece.rows)),
                    collapsed=_collapsed(piece, runs),
                )

    return ids_and_texts(docs, id_column, text_column).mapInArrow(rows, f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")


def with_looped_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the end of every tenth document or so repeats some of its words.

    h is the id's crc32, g a tenth of it: if h ends in 0, the words from number a = g % n on
    repeat the first p = 1 + floor((n - a) / (3 + g % 8)) of them. A row without an id stays.
    """
    pairs = ids_and_texts(docs)
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), SPACE_RUNS), "")
    drawn = pairs.withColumn("h", h).withColumn("w", F.when(F.col("h") % 10 == 0, words))
    drawn = drawn.withColumn("n", F.size("w")).withColumn("g", F.expr("h div 10"))
    drawn = drawn.withColumn("a", F.expr("case when n > 0 then g % n end"))
    drawn = drawn.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    looped = F.expr("array_join(transform(sequence(0, n - 1), i -> w[cast(if(i < a, i, a + (i - a) % p) as int)]), ' ')")
    return drawn.select("doc_id", F.when(F.col("n") > 0, looped).otherwise(F.col("text")).alias("text"))


def _greatest(runs: Column) -> Column:
    """The run of greatest length / period; of equal ones the first by start, then by period."""
    better = lambda x, y: y.length * x.period > x.length * y.period
    return F.aggregate(runs, F.element_at(runs, 1), lambda x, y: F.when(better(x, y), y).otherwise(x))


def run_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the greatest run and two digests of each row of ``periodic_runs``."""
    best = found.withColumn("best", F.when(F.size("runs") > 0, _greatest(F.col("runs"))))
    lines = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
