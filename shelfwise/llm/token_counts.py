"""Token counts that follow edits without encoding a document again.

A document's text is cut where a byte-level pre-token surely begins (a space before a
non-space) into leaves of ``LEAF_PARTS`` parts. A segment tree over the leaves sums
characters and tokens. An edit finds its leaves by descending the character sums; only
their text, edited, is encoded again, once for all edits of a region. If an edit touches the first characters of
its first leaf, which made it a sure cut (a space, and no added token after it), leaves before join in as context; the leaf
after needs none, since its own first characters are untouched. The leaves get their
new sums, and so do their ancestors.

An edit replaces the characters from ``start`` to ``finish`` by ``insert``. The edits of
a document are applied in the order given, each to the text that those before left.
Places beyond the text's end mean its end; a ``finish`` before ``start`` means ``start``.

Trees are tables (leaf sizes and counts, and how many equal rows they stand for), so
counts of later versions start from them. Edits come with the text they are for and find
their tree by the document's id and a hash of that text; unedited texts are not moved.

Cases: null texts are empty and have no tokens; rows without an id have trees and edits
of their own like any other; equal rows share a tree and are each returned; edits for
texts that have no tree are ignored; a null insert is empty.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import words
from shelfwise.llm.columns import batch_of, ids_and_texts
from shelfwise.llm.staging import staged
from shelfwise.llm.token_ids import LONGEST_ADDED, PIECE_BYTES, ByteLevelParts, byte_level, encoder

TOKENIZER = "byte_bpe_50k.json"
LEAF_PARTS = 16
SURE_CHARS = 1 + LONGEST_ADDED
TEXTS_AT_ONCE = 128
KEY = ["doc_id", "digest"]
EDITS = "array<struct<start:long,finish:long,insert:string>>"

#: What a cleaning pass over text replaces, by what, and characters without which it cannot match.
#: An address has at most 64 characters before its sign, so that a long run of letters is scanned in
#: time that grows with its length alone; of a longer run the last 64 belong to the address.
CLEANING = (
    (r"[\w.+-]{1,64}@[\w-]+\.[\w.]+", "<email>", "@"),
    (r"\d{5,}", "<number>", ""),
    (r"([!$%&*#|])\1{2,}", r"\1", ""),
    (r" {2,}", " ", "  "),
)


class SegmentTree:
    """Sums of characters and tokens over leaves; ``texts`` holds the leaves' text."""

    def __init__(self, texts: list[str], tokens: Sequence[int]):
        self.n = 1 << max(0, len(texts) - 1).bit_length()
        self.texts = texts + [""] * (self.n - len(texts))
        self.chars = [0] * self.n + [len(t) for t in self.texts]
        self.tokens = [0] * self.n + [*tokens, *[0] * (self.n - len(tokens))]
        for node in range(self.n - 1, 0, -1):
            self._sum(node)
        self.encoded_chars = self.encoded_leaves = 0

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and where it starts; the last leaf with text for the end."""
        place = min(place, self.chars[1] - 1)
        node, start = 1, 0
        while node < self.n:
            node *= 2
            if place - start >= self.chars[node]:
                start += self.chars[node]
                node += 1
        return node - self.n, start

    def set(self, leaf: int, text: str, tokens: int) -> None:
        self.texts[leaf] = text
        node = leaf + self.n
        self.chars[node], self.tokens[node] = len(text), tokens
        while node > 1:
            node //= 2
            self._sum(node)

    def regions(self, edits: Sequence[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        """Leaves from, leaves to, and new text of each region that edits touch.

        Each edit must end where the one before it starts, or earlier.
        """
        total, found = self.chars[1], []
        if not total:
            return [(0, 0, "".join(insert for _, _, insert in reversed(edits)))]
        for start, finish, insert in edits:
            start = min(max(start, 0), total)
            finish = min(max(finish, start), total)
            first, at = self.find(start)
            while start - at < SURE_CHARS and at:
                first, at = self.find(at - 1)
            last = max(first, self.find(max(finish - 1, start))[0])
            if found and found[-1]["first"] <= last:  # the region of the edits before it grows
                region = found[-1]
                if first < region["first"]:
                    region["text"] = "".join(self.texts[first : region["first"]]) + region["text"]
                    region["first"], region["at"] = first, at
            else:
                region = {"first": first, "last": last, "at": at, "text": "".join(self.texts[first : last + 1])}
                found.append(region)
            text, at = region["text"], region["at"]
            region["text"] = text[: start - at] + insert + text[finish - at :]
        return [(r["first"], r["last"], r["text"]) for r in found]

    def replace(self, first: int, last: int, text: str, tokens: int) -> None:
        """Give leaves a new text, all of it in the first."""
        self.set(first, text, tokens)
        for leaf in range(first + 1, last + 1):
            if self.texts[leaf]:
                self.set(leaf, "", 0)
        self.encoded_chars += len(text)
        self.encoded_leaves += last - first + 1

    def edit(self, start: int, finish: int, insert: str, count) -> None:
        """Replace characters; ``count`` gives the tokens of a text."""
        for first, last, text in self.regions([(start, finish, insert)]):
            self.replace(first, last, text, count(text))


def in_turns(edits: Sequence[dict], length: int) -> list[list[tuple[int, int, str]]]:
    """Edits of a text of this length, in runs in which each ends where the one before it starts, or earlier.

    The places of a run are those of the text before the run.
    """
    turns: list[list[tuple[int, int, str]]] = []
    for edit in edits:
        start = min(max(edit["start"] or 0, 0), length)
        finish = min(max(edit["finish"] or 0, start), length)
        made = (start, finish, edit["insert"] or "")
        length += len(made[2]) - (finish - start)
        if turns and finish <= turns[-1][-1][0]:
            turns[-1].append(made)
        else:
            turns.append([made])
    return turns


def leaf_starts(piece: words.Piece) -> tuple[np.ndarray, np.ndarray]:
    """The parts that begin a leaf, and for each text the first of its leaves."""
    within = np.arange(len(piece.starts)) - np.repeat(piece.first[:-1], np.diff(piece.first))
    begins = np.flatnonzero(within % LEAF_PARTS == 0)
    return begins, np.searchsorted(begins, piece.first)


def leaves_of(text: str) -> list[str]:
    """The leaves of one text."""
    piece = next(words.pieces(pa.array([text], pa.string()), kind=ByteLevelParts))
    at = np.append(piece.starts[leaf_starts(piece)[0]], len(piece.data)).tolist()
    raw = piece.data.tobytes()
    return [raw[a:b].decode() for a, b in zip(at[:-1], at[1:], strict=True)]


def _keyed(docs: DataFrame) -> DataFrame:
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.select("doc_id", F.xxhash64("text").alias("digest"), "text")


def token_trees(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", added_tokens: bool = False
) -> DataFrame:
    """doc_id, digest, the characters and tokens of each leaf, and copies, of each different row."""

    def trees(batches):
        encode = encoder(tokenizer_path, byte_level(added_tokens), added_tokens)
        for batch in batches:
            for piece in words.pieces(batch.column(2), limit=PIECE_BYTES, kind=byte_level(added_tokens)):
                _, size = encode.piece_ids(piece)
                begins, first = leaf_starts(piece)
                letters = np.concatenate(([0], np.cumsum((piece.data & 0xC0) != 0x80)))  # not within a character
                ends = np.append(piece.starts[begins], len(piece.data))
                tokens = np.add.reduceat(size, begins) if len(begins) else size
                offsets = pa.array(first, pa.int32())
                rows = slice(piece.rows.start, piece.rows.stop)
                yield batch_of(
                    doc_id=batch.column(0)[rows],
                    digest=batch.column(1)[rows],
                    leaf_chars=pa.ListArray.from_arrays(offsets, pa.array(np.diff(letters[ends]), pa.int32())),
                    leaf_tokens=pa.ListArray.from_arrays(offsets, pa.array(tokens, pa.int32())),
                )

    rows = _keyed(ids_and_texts(docs, id_column, text_column))
    made = rows.mapInArrow(trees, "doc_id long, digest long, leaf_chars array<int>, leaf_tokens array<int>")
    leaves = [F.first(c).alias(c) for c in ("leaf_chars", "leaf_tokens")]
    return made.groupBy(*KEY).agg(*leaves, F.count("*").alias("copies"))


def cleaning_edits(docs: DataFrame, rules: Sequence[tuple[str, str, str]] = CLEANING) -> DataFrame:
    """doc_id, digest, text and the edits by which a cleaning pass changes each different text."""
    patterns = [(re.compile(pattern), to, needs) for pattern, to, needs in rules]

    def edits(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, TEXTS_AT_ONCE):
                piece = batch.slice(k, TEXTS_AT_ONCE)
                found = [_edits(text, patterns) for text in piece.column(2).to_pylist()]
                made = batch_of(doc_id=piece.column(0), digest=piece.column(1), text=piece.column(2), edits=pa.array(found, _EDIT_TYPE))
                yield made.filter(pa.array([bool(own) for own in found]))

    made = _keyed(ids_and_texts(docs)).mapInArrow(edits, f"doc_id long, digest long, text string, edits {EDITS}")
    return made.dropDuplicates(KEY)


_EDIT_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("finish", pa.int64()), ("insert", pa.string())]))


def _edits(text: str, patterns: list[tuple[re.Pattern, str, str]]) -> list[dict]:
    """Replacements that do not overlap, the last in the text first, so places stay valid."""
    found = sorted((m.start(), m.end(), m.expand(to)) for pattern, to, needs in patterns if needs in text for m in pattern.finditer(text))
    kept, end = [], 0
    for start, finish, insert in found:
        if start >= end:
            kept.append({"start": start, "finish": finish, "insert": insert})
            end = finish
    return kept[::-1]


def counts_after_edits(trees: DataFrame, edits: DataFrame, tokenizer_path: str, added_tokens: bool = False) -> DataFrame:
    """Token counts of each row before and after its edits, and how much was encoded again.

    Columns: doc_id, n_tokens, n_edits, n_tokens_after, n_leaves, encoded_leaves, encoded_chars.
    """
    other = edits.select(*[F.col(c).alias(f"other_{c}") for c in KEY], "text", "edits")
    same = trees["doc_id"].eqNullSafe(other["other_doc_id"]) & (trees["digest"] == other["other_digest"])
    rows = trees.join(other, same, "left").select("doc_id", "text", "leaf_chars", "leaf_tokens", "edits", "copies")

    def trees_of(batch: pa.RecordBatch) -> list[tuple[SegmentTree | None, list]]:
        found = []
        for row in range(batch.num_rows):
            text, chars, tokens, edits = (batch.column(k)[row].as_py() for k in range(1, 5))
            if not edits:
                found.append((None, []))
                continue
            ends = np.cumsum([0, *chars]).tolist()
            leaves = [text[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            found.append((SegmentTree(leaves, tokens), in_turns(edits, len(text))))
        return found

    def counted(batches):
        encode = encoder(tokenizer_path, byte_level(added_tokens), added_tokens)
        for whole in batches:
            for k in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(k, TEXTS_AT_ONCE)
                trees = trees_of(batch)
                for turn in range(max(len(turns) for _, turns in trees)):
                    regions = [(tree, r) for tree, turns in trees if turn < len(turns) for r in tree.regions(turns[turn])]
                    sizes = encode.counts(pa.array([text for _, (_, _, text) in regions], pa.string()))
                    for (tree, (first, last, text)), size in zip(regions, sizes, strict=True):
                        tree.replace(first, last, text, size)
                yield _row_counts(batch, trees)

    names = ("n_tokens", "n_edits", "n_tokens_after", "n_leaves", "encoded_leaves", "encoded_chars")
    result = rows.mapInArrow(counted, f"doc_id long, copies long, {', '.join(f'{n} long' for n in names)}")
    return result.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copy", "copies")


def _row_counts(batch: pa.RecordBatch, trees: list[tuple[SegmentTree | None, list]]) -> pa.RecordBatch:
    before = [sum(tokens.as_py()) for tokens in batch.column(3)]
    columns = {
        "doc_id": batch.column(0),
        "copies": batch.column(5),
        "n_tokens": before,
        "n_edits": [sum(map(len, turns)) for _, turns in trees],
        "n_tokens_after": [tree.n_tokens if tree else n for (tree, _), n in zip(trees, before, strict=True)],
        "n_leaves": [len(tokens) for tokens in batch.column(3)],
        "encoded_leaves": [tree.encoded_leaves if tree else 0 for tree, _ in trees],
        "encoded_chars": [tree.encoded_chars if tree else 0 for tree, _ in trees],
    }
    return pa.RecordBatch.from_pydict({n: c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for n, c in columns.items()})


def cleaned_token_counts(docs: DataFrame, tokenizer_path: str, added_tokens: bool = False) -> DataFrame:
    """Token counts of all documents, and of what a cleaning pass makes of them."""
    trees = staged(token_trees(docs, tokenizer_path, added_tokens=added_tokens), "token-trees")
    return counts_after_edits(trees, cleaning_edits(docs), tokenizer_path, added_tokens)
