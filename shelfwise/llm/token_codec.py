"""Token ids in files, compressed by an adaptive context-mixing range coder.

A file holds segments, a segment consecutive documents in order of their ids: which
documents, how many ids each, and a payload of blocks of ``BLOCK`` ids. Every block is
coded from a fresh model and has a CRC-32, so a damaged block harms no other.

Model. The two previous ids (order 2) and the last one (order 1) each predict an id:
the one that followed last time, with a count of how often it did. Whether the next id
is the one, the other or neither is coded with the sum of two adaptive count tables,
one for each order's confidence, which mixes the orders by their evidence. What neither
predicts is coded by order 0: adaptive counts of the id's upper eight bits, then its
lower eight bits as they are.

Coder. A carry-less range coder with 64-bit state and 16-bit words. All blocks of a
segment advance together, one id at a time: the numpy lanes are blocks.

Reading back checks every block's sum and needs nothing but the files.

Cases: a null or empty text is the end id alone; documents without an id come first;
rows of equal id stand in order of their texts; an empty table has no segments.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.columns import batch_of, ids_and_texts
from shelfwise.llm.token_ids import ID, WordParts, encoder

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
BLOCK = 4096
SEGMENT = 2048 * BLOCK
MAGIC = b"TIDS1"
HEADER = struct.Struct("<5sIII")  # magic, ids, ids in a block, blocks
BITS1, BITS2 = 10, 12
STEP, MOST = 24, 1 << 12
TOP, LEAST = np.uint64(1 << 48), np.uint64(1 << 32)
WORD, LOW_WORD = np.uint64(16), np.uint64(48)


class Counts:
    """Adaptive counts of a few symbols in several contexts, for each lane."""

    def __init__(self, lanes: int, contexts: int, symbols: int):
        self.table = np.ones((lanes * contexts, symbols), np.int32)
        self.contexts = contexts

    def rows(self, lanes: np.ndarray, context) -> np.ndarray:
        return lanes * self.contexts + context

    def add(self, rows: np.ndarray, symbol: np.ndarray) -> None:
        self.table[rows, symbol] += STEP
        full = rows[self.table[rows, symbol] > MOST]
        if len(full):
            self.table[full] = (self.table[full] + 1) >> 1


class Model:
    """Predictions of orders 2, 1 and 0 in every lane."""

    def __init__(self, lanes: int):
        self.second, self.first = np.zeros(lanes << BITS2, np.int32), np.zeros(lanes << BITS1, np.int32)
        self.by_second, self.by_first = Counts(lanes, 4, 3), Counts(lanes, 8, 3)
        self.upper, self.lower = Counts(lanes, 1, 16), Counts(lanes, 16, 16)
        self.last, self.before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)

    def predict(self, lanes: np.ndarray) -> np.ndarray:
        """Mixed counts of: what order 2 predicts, what order 1 does, neither."""
        n = len(lanes)
        last, before = self.last[:n], self.before[:n]
        self.at2 = (lanes << BITS2) | (((last * 0x9E3779B1 + before * 0x85EBCA6B) >> 12) & ((1 << BITS2) - 1))
        self.at1 = (lanes << BITS1) | (((last * 0x9E3779B1) >> 14) & ((1 << BITS1) - 1))
        self.entry2, self.entry1 = self.second[self.at2], self.first[self.at1]
        self.id2, self.id1 = self.entry2 >> 2, self.entry1 >> 2
        self.rows2 = self.by_second.rows(lanes, self.entry2 & 3)
        self.rows1 = self.by_first.rows(lanes, (self.entry1 & 3) * 2 + (self.id1 == self.id2))
        return self.by_second.table[self.rows2] + self.by_first.table[self.rows1]

    def symbol(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids == self.id2, 0, np.where(ids == self.id1, 1, 2))

    def learn(self, ids: np.ndarray, symbol: np.ndarray) -> None:
        n = len(ids)
        self.by_second.add(self.rows2, symbol)
        self.by_first.add(self.rows1, symbol)
        for table, at, entry, told in ((self.second, self.at2, self.entry2, self.id2), (self.first, self.at1, self.entry1, self.id1)):
            sure = entry & 3
            table[at] = np.where(told == ids, (ids << 2) | np.minimum(sure + 1, 3), np.where(sure > 1, entry - 2, ids << 2))
        self.before[:n] = self.last[:n]
        self.last[:n] = ids


class Encoder:
    """Range encoders, one a lane."""

    def __init__(self, lanes: int, words: int):
        self.low, self.range = np.zeros(lanes, np.uint64), np.full(lanes, np.iinfo(np.uint64).max, np.uint64)
        self.out, self.size = np.zeros((lanes, words), np.uint16), np.zeros(lanes, np.int64)

    def put(self, lanes: np.ndarray, below: np.ndarray, count: np.ndarray, total: np.ndarray) -> None:
        share = self.range[lanes] // total.astype(np.uint64)
        low = self.low[lanes] + share * below.astype(np.uint64)
        width = share * count.astype(np.uint64)
        self.low[lanes], self.range[lanes] = low, width
        while True:
            settled = (low ^ (low + width)) < TOP
            again = np.flatnonzero(settled | (width < LEAST))
            if not len(again):
                return
            lanes, low, width, settled = lanes[again], low[again], width[again], settled[again]
            width = np.where(settled, width, (~low + np.uint64(1)) & (LEAST - np.uint64(1)))
            self.out[lanes, self.size[lanes]] = (low >> LOW_WORD).astype(np.uint16)
            self.size[lanes] += 1
            low, width = low << WORD, width << WORD
            self.low[lanes], self.range[lanes] = low, width

    def finish(self) -> list[bytes]:
        lanes = np.arange(len(self.low))
        for _ in range(4):
            self.out[lanes, self.size] = (self.low >> LOW_WORD).astype(np.uint16)
            self.size += 1
            self.low <<= WORD
        return [row[:n].astype("<u2").tobytes() for row, n in zip(self.out, self.size.tolist(), strict=True)]


class Decoder:
    """Range decoders, one a lane."""

    def __init__(self, blocks: list[bytes]):
        lanes = len(blocks)
        words = max(len(b) for b in blocks) // 2 + 4
        self.data = np.zeros((lanes, words), np.uint64)
        for k, b in enumerate(blocks):
            self.data[k, : len(b) // 2] = np.frombuffer(b, "<u2")
        self.low, self.range = np.zeros(lanes, np.uint64), np.full(lanes, np.iinfo(np.uint64).max, np.uint64)
        self.code = (self.data[:, 0] << np.uint64(48)) | (self.data[:, 1] << np.uint64(32)) | (self.data[:, 2] << WORD) | self.data[:, 3]
        self.at = np.full(lanes, 4)

    def look(self, lanes: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Where each lane's value lies among ``total`` counts."""
        total = total.astype(np.uint64)
        self.share = self.range[lanes] // total
        return np.minimum((self.code[lanes] - self.low[lanes]) // self.share, total - np.uint64(1)).astype(np.int64)

    def take(self, lanes: np.ndarray, below: np.ndarray, count: np.ndarray) -> None:
        low = self.low[lanes] + self.share * below.astype(np.uint64)
        width = self.share * count.astype(np.uint64)
        self.low[lanes], self.range[lanes] = low, width
        while True:
            settled = (low ^ (low + width)) < TOP
            again = np.flatnonzero(settled | (width < LEAST))
            if not len(again):
                return
            lanes, low, width, settled = lanes[again], low[again], width[again], settled[again]
            width = np.where(settled, width, (~low + np.uint64(1)) & (LEAST - np.uint64(1)))
            self.code[lanes] = (self.code[lanes] << WORD) | self.data[lanes, np.minimum(self.at[lanes], self.data.shape[1] - 1)]
            self.at[lanes] += 1
            low, width = low << WORD, width << WORD
            self.low[lanes], self.range[lanes] = low, width


def _bounds(counts: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts below a symbol, its own, and all."""
    sums = np.cumsum(counts, axis=1)
    row = np.arange(len(symbol))
    own = counts[row, symbol]
    return sums[row, symbol] - own, own, sums[:, -1]


def encode_blocks(ids: np.ndarray, block: int = BLOCK) -> list[bytes]:
    """Each block of ids, coded on its own."""
    n_blocks = -(-len(ids) // block)
    grid = np.zeros((n_blocks, block), np.int32)
    grid.reshape(-1)[: len(ids)] = ids
    lengths = np.full(n_blocks, block)
    lengths[-1] = len(ids) - (n_blocks - 1) * block
    model, coder, all_lanes = Model(n_blocks), Encoder(n_blocks, 3 * block + 16), np.arange(n_blocks)
    columns = np.ascontiguousarray(grid.T)
    for t in range(int(lengths.max())):
        lanes = all_lanes if t < lengths[-1] else all_lanes[:-1]
        now = columns[t, : len(lanes)]
        counts = model.predict(lanes)
        symbol = model.symbol(now)
        coder.put(lanes, *_bounds(counts, symbol))
        new = np.flatnonzero(symbol == 2)
        if len(new):
            value, some = now[new], lanes[new]
            high, middle = value >> 12, (value >> 8) & 15
            for table, context, part in ((model.upper, 0, high), (model.lower, high, middle)):
                rows = table.rows(some, context)
                coder.put(some, *_bounds(table.table[rows], part))
                table.add(rows, part)
            coder.put(some, value & 255, np.ones_like(value), np.full_like(value, 256))
        model.learn(now, symbol)
    return coder.finish()


def decode_blocks(blocks: list[bytes], n_ids: int, block: int = BLOCK) -> np.ndarray:
    """The ids that were encoded."""
    lengths_last = n_ids - (len(blocks) - 1) * block
    model, coder, all_lanes = Model(len(blocks)), Decoder(blocks), np.arange(len(blocks))
    columns = np.zeros((block, len(blocks)), np.int32)

    def read(lanes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        sums = np.cumsum(counts, axis=1)
        value = coder.look(lanes, sums[:, -1])
        symbol = (sums <= value[:, None]).sum(axis=1)
        row = np.arange(len(lanes))
        own = counts[row, symbol]
        coder.take(lanes, sums[row, symbol] - own, own)
        return symbol

    for t in range(min(block, n_ids)):
        lanes = all_lanes if t < lengths_last else all_lanes[:-1]
        symbol = read(lanes, model.predict(lanes))
        now = np.where(symbol == 0, model.id2, model.id1)
        new = np.flatnonzero(symbol == 2)
        if len(new):
            some = lanes[new]
            rows = model.upper.rows(some, 0)
            high = read(some, model.upper.table[rows])
            model.upper.add(rows, high)
            rows = model.lower.rows(some, high)
            middle = read(some, model.lower.table[rows])
            model.lower.add(rows, middle)
            low = coder.look(some, np.full(len(some), 256))
            coder.take(some, low, np.ones(len(some)))
            now[new] = (high << 12) | (middle << 8) | low
        now = now.astype(np.int32)
        columns[t, : len(lanes)] = now
        model.learn(now, symbol)
    return np.ascontiguousarray(columns.T).reshape(-1)[:n_ids]


def to_payload(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """A segment's payload: header, each block's length and sum, the blocks."""
    blocks = encode_blocks(ids, block) if len(ids) else []
    sums = [zlib.crc32(ids[k : k + block].astype(ID).tobytes()) for k in range(0, len(ids), block)]
    index = np.array([v for pair in zip(map(len, blocks), sums, strict=True) for v in pair], ID)
    return HEADER.pack(MAGIC, len(ids), block, len(blocks)) + index.tobytes() + b"".join(blocks)


def from_payload(payload: bytes) -> np.ndarray:
    """A segment's ids; an error if a block's sum does not hold."""
    magic, n_ids, block, n_blocks = HEADER.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a token id segment")
    index = np.frombuffer(payload, ID, 2 * n_blocks, HEADER.size).reshape(-1, 2)
    ends = HEADER.size + 8 * n_blocks + np.cumsum([0, *index[:, 0].tolist()])
    if not n_blocks:
        return np.empty(0, ID)
    ids = decode_blocks([payload[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], n_ids, block).astype(ID)
    for k, expected in enumerate(index[:, 1].tolist()):
        if zlib.crc32(ids[k * block : (k + 1) * block].tobytes()) != expected:
            raise ValueError(f"block {k} is damaged")
    return ids


SEGMENTS = "part int, segment int, n_ids long, doc_ids array<long>, lengths array<long>, payload binary"


def write_token_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, added_tokens: bool = False) -> None:
    """Write the ids of all documents, in order of their ids, to ``path``."""

    def segments(batches) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer_path, WordParts, added_tokens), np.array([end_id], ID)
        part, number = TaskContext.get().partitionId(), 0
        ids, made, total = [], [], 0

        def closed() -> pa.RecordBatch:
            payload = to_payload(np.concatenate(made))
            return batch_of(
                part=pa.array([part], pa.int32()),
                segment=pa.array([number], pa.int32()),
                n_ids=pa.array([total], pa.int64()),
                doc_ids=pa.array([ids], pa.list_(pa.int64())),
                lengths=pa.array([[len(own) for own in made]], pa.list_(pa.int64())),
                payload=pa.array([payload], pa.binary()),
            )

        for batch in batches:
            known = batch.column(0).to_pylist()
            for row, own in encode.documents(batch.column(1)):
                ids.append(known[row])
                made.append(np.concatenate((own, end)))
                total += len(own) + 1
                if total >= SEGMENT:
                    yield closed()
                    ids, made, total, number = [], [], 0, number + 1
        if ids:
            yield closed()

    order = ["doc_id", "text"]
    placed = docs.repartitionByRange("doc_id").sortWithinPartitions(*order)
    placed.mapInArrow(segments, SEGMENTS).write.parquet(path)


def read_token_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document in the files, and its ids if asked for."""
    files = spark.read.schema(SEGMENTS).parquet(path)
    order = Window.orderBy("part", "segment").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each segment of millions of ids.
    sizes = files.select("part", "segment", "n_ids")
    offsets = sizes.select("part", "segment", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("offset"))
    schema = "part int, segment int, doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def documents(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                part, segment, doc_ids, lengths, payload = (batch.column(k)[row].as_py() for k in (0, 1, 3, 4, 5))
                ids = from_payload(payload)
                ends = np.cumsum([0, *lengths])
                spans = list(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))
                columns = {
                    "part": pa.array([part] * len(spans), pa.int32()),
                    "segment": pa.array([segment] * len(spans), pa.int32()),
                    "doc_id": pa.array(doc_ids, pa.int64()),
                    "start": pa.array(ends[:-1], pa.int64()),
                    "n_tokens": pa.array(lengths, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in spans], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array([ids[a:b].astype(np.int64) for a, b in spans], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    found = files.mapInArrow(documents, schema).join(offsets, ["part", "segment"])
    return found.withColumn("start", F.col("start") + F.col("offset")).drop("part", "segment", "offset")


def coded_documents(docs: DataFrame, path: str, tokenizer_path: str, added_tokens: bool = False) -> DataFrame:
    """Write all documents' ids to ``path`` and return what the files hold."""
    write_token_ids(ids_and_texts(docs), path, tokenizer_path, added_tokens=added_tokens)
    return read_token_ids(docs.sparkSession, path)
