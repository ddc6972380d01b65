"""Exact similarity join of documents on word shingles, with PartEnum signatures.

A document's set holds its distinct runs of five words (A-Z in lower case); with
fewer words, the whole sequence is its one element. Two documents link when the
Jaccard similarity of their sets is at least ``percent`` / 100, in integers.

Method. Sizes are cut into bands whose ends differ by the threshold, so similar
sets lie in one band or in neighbouring ones, and their symmetric difference is
at most ``k`` for the band. The domain of shingles is cut into ``n1`` first-level
parts of three cells each. If two sets differ in at most k elements, some parts
see at most one difference; there, two of the three cells agree. A signature is a
hash of the contents of two cells of a part: every 2-subset of each part's cells
is enumerated, for the set's own band and the next. Similar sets share one.

Some extra parts guarantee that more than ``slack`` parts agree. A set may then
leave out its lightest signatures (those of at most ``light`` elements) as long as
at most ``slack`` of its parts have such a one: of two similar sets, the part that
remains agrees for both. That drops empty and one-shingle signatures, which a shared
passage would otherwise make common. What a set's own size allows to differ gives it
a slack of its own.

A set that links with another has at least ``percent`` of its shingles in common with
it. So a set goes, and gets no signatures, if more than the rest are lone in the lower half
of the hash space alone; ``dealt`` counts them without a table that grows with the
input in any task, and never takes a repeated shingle for a lone one. Sets that are equal are
one class first, so copies cost nothing. How many shingles of a set other classes repeat, by a
count-min sketch of what is left, bounds the size of a partner: a copy with many changes of
its own has none.

Within a signature, members are compared with a hub (the member with the fewest
shingles of its own, then others), and linked groups are merged. What remains is every
pair that shares a signature, lies in different groups and has sizes that allow a link:
all these are verified, so no link between components is lost. Of each signature the
largest group is not held against itself: only members outside it meet all others, in
chunks. Of signatures with the same members one is kept.

Two members meet under a condition of the join itself: a set has a parity bit for each of
``PARITY_BITS`` cells, whether it holds an odd number of that cell's elements. Sets that
differ in d elements differ in at most d bits, so pairs with more bits than similar
sets have elements to differ in never leave the join. What does is held against each other by
outlines, a byte for a few elements: outlines that differ in more cells than similar sets do
in elements rule a pair out.

``jaccard_components`` looks only for links between components. ``jaccard_links`` gives
every link between different texts: all pairs of a signature are verified, in chunks of
its members, so that no task holds a whole group; there may be as many as a group's square.

Cases: null and empty texts have an empty set and link with nothing; rows of one
id are one vertex; rows without an id have no component; other columns are not
read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import words
from shelfwise.llm.columns import batch_of, character_total, ids_and_texts
from shelfwise.llm.dealt import SCHEMA as CHUNKS
from shelfwise.llm.dealt import Cells, Chunk, mostly_shared
from shelfwise.llm.links import components
from shelfwise.llm.sketch import repeated
from shelfwise.llm.staging import bucketed, discard, staged, staged_alone

WIDTH = 5
PERCENT = 80
#: Bytes of text for one shingle, roughly.
BYTES_A_SHINGLE = 6
#: What tells sets apart.
SAME = ["n_shingles", "one", "two"]
CELLS_A_SET = 8
CELLS = 3
HUB_ROUNDS = 3
SETS_AT_ONCE = 200
CHUNK = 256
WEIGHINGS = 2
PARITY_BITS = 1024
#: Rows of later copies (40 bytes each) that are sent to every task; more are joined by a shuffle.
MOST_BROADCAST = 500_000
ONE, OTHER = [0, 0, 1], [1, 2, 2]  # the 2-subsets of three cells
KEY, VALUE, MIX, PLACE = (np.uint64(x) for x in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7))


class Bands:
    """Size bands for a threshold, and the parameters of each."""

    def __init__(self, percent: int):
        self.last: list[int] = []
        self.percent = percent
        low = 1
        while low < 1 << 40:
            self.last.append(max(low, low * 100 // percent))
            low = self.last[-1] + 1

    def of(self, size: int) -> int:
        return bisect_left(self.last, size)

    def differ(self, both: int) -> int:
        """In how many elements similar sets may differ that have ``both`` elements together."""
        return both * (100 - self.percent) // (100 + self.percent)

    def parts(self, band: int, size: int) -> tuple[int, int]:
        """First-level parts of a band, and how many a set of this size may leave out."""
        most = self.differ(2 * self.last[band])
        least = most // 2 + 1
        n_parts = least if most < 4 else least + 2 + least // 6
        own = self.differ(size + min(self.last[band], size * 100 // self.percent))
        return n_parts, n_parts - own // 2 - 1


def signatures(elements: np.ndarray, bands: Bands) -> np.ndarray:
    """The signatures of a set of 64-bit elements; none where similar means equal."""
    if not len(elements):
        return np.empty(0, np.uint64)
    high, low = elements >> np.uint64(32), elements & np.uint64(0xFFFFFFFF)
    cell_in_part = (low * np.uint64(CELLS)) >> np.uint64(32)
    values = words.mixed(elements ^ VALUE)
    found = []
    own = bands.of(len(elements))
    for band in (own, own + 1):
        if not bands.differ(2 * bands.last[band]):
            continue
        n_parts, slack = bands.parts(band, len(elements))
        cell = (((high * np.uint64(n_parts)) >> np.uint64(32)) * np.uint64(CELLS) + cell_in_part).astype(np.int64)
        sums = np.zeros(n_parts * CELLS, np.uint64)
        np.add.at(sums, cell, values)
        sums = sums.reshape(n_parts, CELLS)
        counts = np.bincount(cell, minlength=n_parts * CELLS).reshape(n_parts, CELLS)
        in_pair = counts[:, ONE] + counts[:, OTHER]
        light = np.partition(in_pair.min(axis=1), slack)[slack] - 1
        place = np.arange(n_parts * CELLS, dtype=np.uint64).reshape(n_parts, CELLS) + np.uint64(band << 40)
        made = words.mixed(sums[:, ONE] * MIX + words.mixed(sums[:, OTHER] ^ KEY) + place * PLACE)
        found.append(made[in_pair > light])
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def shingle_sets(piece: words.Piece, width: int = WIDTH):
    """The sorted distinct shingle hashes of each document of a piece, with its row."""
    hashes = piece.hashes()
    runs = words.window_hashes(hashes, width)
    for k, row in enumerate(piece.rows):
        a, b = piece.first[k], piece.first[k + 1]
        if b - a >= width:
            own = np.sort(runs[a : b - width + 1])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        else:
            own = words.window_hashes(hashes[a:b], b - a) if b > a else hashes[:0]
        yield row, own


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values) if values else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def _measured(docs: DataFrame, width: int, cells: Cells) -> DataFrame:
    """Size and two hashes of each row's set; beside them, without them, the rows of chunks (``dealt``) that hold the sets' cells."""

    def rows(batches):
        chunk = Chunk(cells)

        def beside(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in found:
                none = pa.nulls(part.num_rows, pa.int64())
                yield batch_of(doc_id=none, n_shingles=none, one=none, two=none, **dict(zip(part.schema.names, part.columns, strict=True)))

        for batch in batches:
            for piece in words.pieces(batch.column(1), lower=True):
                sets = [own for _, own in shingle_sets(piece, width)]
                names = _names(sets)
                yield batch_of(
                    doc_id=batch.column(0).slice(piece.rows.start, len(piece.rows)),
                    **{c: pa.array(np.ascontiguousarray(names[:, k])) for k, c in enumerate(SAME)},
                    chunk=pa.nulls(len(sets), pa.int64()),
                    segment=pa.nulls(len(sets), pa.int32()),
                    cells=pa.nulls(len(sets), pa.binary()),
                    owners=pa.nulls(len(sets), pa.binary()),
                )
                yield from beside(chunk.add(sets, names))
        yield from beside(chunk.rows())

    return docs.mapInArrow(rows, f"doc_id long, n_shingles long, one long, two long, {CHUNKS}")


def _names(sets: list[np.ndarray]) -> np.ndarray:
    """What tells sets apart: size and two hashes."""
    made = [(len(own), words.mixed(own ^ KEY).sum(dtype=np.uint64), words.mixed(own ^ PLACE).sum(dtype=np.uint64)) for own in sets]
    return np.array(made, np.uint64).reshape(-1, len(SAME)).view(np.int64)


def _candidates(docs: DataFrame, shared: DataFrame, width: int) -> DataFrame:
    """The sets whose size and hashes ``shared`` has, and few others."""

    def hashes(batch):
        yield batch.column(0).to_numpy().view(np.uint64)

    maybe = repeated(shared.select("one"), hashes, CELLS_A_SET * shared.count(), least=1)

    def rows(batches):
        for batch in batches:
            for piece in words.pieces(batch.column(1), lower=True):
                sets = [own for _, own in shingle_sets(piece, width)]
                names = _names(sets)
                keep = maybe(np.ascontiguousarray(names[:, SAME.index("one")]).view(np.uint64))
                yield batch_of(
                    doc_id=batch.column(0).slice(piece.rows.start, len(piece.rows)).filter(pa.array(keep)),
                    **{c: pa.array(names[keep, k]) for k, c in enumerate(SAME)},
                    elements=_lists([sets[k] for k in np.flatnonzero(keep)]),
                )

    found = docs.mapInArrow(rows, "doc_id long, n_shingles long, one long, two long, elements array<long>")
    return found.where("doc_id is not null and size(elements) > 0")


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All elements of a column of lists, and where each list ends."""
    return lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()


def _weighed(sets: DataFrame, percent: int, elements: int) -> DataFrame:
    """Sets (node, elements) that may have a partner, with their size, ``most`` and ``odd``.

    ``odd`` elements occur in no other set; so ``most`` is the largest size of a partner.
    """

    def parts(lists: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        flat, ends = _flat(lists)
        for k in range(0, len(lists), SETS_AT_ONCE):
            own = ends[k : k + SETS_AT_ONCE + 1]
            yield flat[own[0] : own[-1]], own - own[0]

    maybe = repeated(sets.select("elements"), lambda batch: (flat for flat, _ in parts(batch.column(0))), elements)

    def rows(batches):
        for batch in batches:
            counts = [np.diff(np.concatenate(([0], np.cumsum(maybe(flat))))[ends]) for flat, ends in parts(batch.column(1))]
            shared = np.concatenate([np.empty(0, np.int64), *counts])
            size = np.diff(_flat(batch.column(1))[1]).astype(np.int64)
            most = shared * (100 + percent) // percent - size
            keep = pa.array(most * 100 >= size * percent)
            columns = {"node": batch.column(0), "elements": batch.column(1)}
            columns |= {"size": pa.array(size, pa.int32()), "most": pa.array(most, pa.int32()), "odd": pa.array(size - shared, pa.int32())}
            yield pa.RecordBatch.from_pydict(columns).filter(keep)

    return sets.select("node", "elements").mapInArrow(rows, "node long, elements array<long>, size int, most int, odd int")


def _entries(sets: DataFrame, percent: int) -> DataFrame:
    """(signature, node, size, most, odd) of weighed sets."""
    bands, carried = Bands(percent), ["node", "size", "most", "odd"]

    def rows(batches):
        for batch in batches:
            flat, ends = _flat(batch.column("elements"))
            for k in range(0, batch.num_rows, SETS_AT_ONCE):
                own = ends[k : k + SETS_AT_ONCE + 1]
                made = [signatures(flat[a:b], bands) for a, b in zip(own[:-1], own[1:], strict=True)]
                times = [len(m) for m in made]
                same = {c: pa.array(batch.column(c).slice(k, len(made)).to_numpy().repeat(times)) for c in carried}
                yield batch_of(signature=pa.array(np.concatenate(made).view(np.int64)), **same)

    return sets.mapInArrow(rows, "signature long, node long, size int, most int, odd int")


def _may_link(one: str, other: str):
    """Whether two members' sizes allow a link; ``most`` covers the ratio of sizes."""
    return F.expr(f"{one}.size <= {other}.most and {other}.size <= {one}.most")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    for end in ("b", "a"):
        pairs = pairs.join(sets.select(F.col("node").alias(end), F.col("elements").alias(f"set_{end}")), end)
    shared = F.size(F.array_intersect("set_a", "set_b"))
    either = F.size("set_a") + F.size("set_b") - F.col("shared")
    return pairs.withColumn("shared", shared).where(F.col("shared") * 100 >= either * percent).select("a", "b")


def _different_groups(entries: DataFrame) -> DataFrame:
    """Signatures of more than one node, one of each set of members, and the size of the smallest.

    A member may stand more than once: a row may be repeated, an id may have several texts. So the
    marks are sums, from which nothing cancels out; 40 bits each leave room for 2^24 rows.
    """
    who = [F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("many"), F.min("size").alias("least")]
    who += [F.sum(F.shiftright(F.xxhash64("node", "size", "most", "odd", F.lit(k)), 24)).alias(f"mark_{k}") for k in (1, 2)]
    groups = entries.groupBy("signature").agg(*who).where("low <> high")
    one = groups.groupBy("low", "high", "many", "mark_1", "mark_2").agg(F.min_by("least", "signature").alias("least"), F.min("signature").alias("signature"))
    return one.select("signature", "least")


def _outlines(sets: DataFrame) -> DataFrame:
    """(node, size, outline) of sets: a byte for each of a power of two of cells, the sum of its elements' hashes."""

    def rows(batches):
        for batch in batches:
            flat, ends = _flat(batch.column(1))
            made = []
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                cells = 1 << max(4, int(b - a).bit_length() - 1)
                place = (flat[a:b] & np.uint64(cells - 1)).astype(np.int64)
                sums = np.bincount(place, (words.mixed(flat[a:b] ^ VALUE) & np.uint64(255)).astype(float), cells)
                made.append((sums.astype(np.int64) & 255).astype(np.uint8).tobytes())
            yield batch_of(node=batch.column(0), size=pa.array(np.diff(ends), pa.int64()), outline=pa.array(made, pa.binary()))

    return sets.select("node", "elements").mapInArrow(rows, "node long, size long, outline binary")


def _differing_cells(one: bytes, other: bytes) -> int:
    """Cells that differ, after the larger outline is folded to the size of the smaller."""
    a, b = np.frombuffer(one, np.uint8), np.frombuffer(other, np.uint8)
    if len(a) < len(b):
        a, b = b, a
    a = a.reshape(-1, len(b)).sum(axis=0, dtype=np.uint8)
    return int(np.count_nonzero(a != b))


def _plausible(pairs: DataFrame, outlines: DataFrame, percent: int) -> DataFrame:
    """Pairs whose outlines differ in no more cells than similar sets differ in elements."""
    for end in ("b", "a"):
        named = outlines.select(F.col("node").alias(end), F.col("size").alias(f"size_{end}"), F.col("outline").alias(f"outline_{end}"))
        pairs = pairs.join(named, end)
    small, large = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    bands = Bands(percent)

    def rows(batches):
        for batch in batches:
            both = batch.column("both").to_numpy().tolist()
            outlines = zip(batch.column("outline_a").to_pylist(), batch.column("outline_b").to_pylist(), strict=True)
            keep = [_differing_cells(x, y) <= bands.differ(n) for (x, y), n in zip(outlines, both, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    near = pairs.where(small * 100 >= large * percent).select("a", "b", (small + large).alias("both"), "outline_a", "outline_b")
    return near.mapInArrow(rows, "a long, b long")


MEMBER = "struct(node, size, most) as member"


def _grouped(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with the component of each."""
    known = members.drop("component").join(labels, "node", "left")
    return known.withColumn("component", F.coalesce("component", "node"))


def _open(members: DataFrame) -> DataFrame:
    """Members of the signatures whose members lie in several components, if their sizes allow a link."""
    spans = members.groupBy("signature").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("size").alias("least"))
    several = staged(spans.where("low <> high").select("signature", "least"), "open")
    return members.join(several, "signature").where("most >= least").drop("least")


def _pair(one: str, other: str) -> list:
    return [F.least(f"{one}.node", f"{other}.node").alias("a"), F.greatest(f"{one}.node", f"{other}.node").alias("b")]


def _hub_pairs(members: DataFrame, turn: int) -> DataFrame:
    """For each node, the hub it shares most signatures with; the hubs differ from turn to turn."""
    order = F.xxhash64("node", F.lit(turn)) if turn else F.struct("odd", "node")
    hubs = members.selectExpr("signature", "node", "odd", MEMBER).groupBy("signature").agg(F.min_by("member", order).alias("hub"))
    both = members.selectExpr("signature", MEMBER).join(staged(hubs, "hubs"), "signature")
    both = both.where((F.col("member.node") != F.col("hub.node")) & _may_link("member", "hub"))
    shared = both.select(F.col("member.node").alias("node"), "hub").groupBy("node", "hub").count()
    best = shared.groupBy("node").agg(F.max_by("hub", F.struct("count", "hub")).alias("hub"))
    return best.select(F.struct("node").alias("member"), "hub").select(*_pair("member", "hub")).distinct()


PARITIES = [f"p{k}" for k in range(PARITY_BITS // 64)]
CARRIED = f"struct(node, size, most, {', '.join(PARITIES)}) as"


def _parities(sets: DataFrame) -> DataFrame:
    """(node, p0, p1, ...): the parity bits of sets."""

    def rows(batches):
        for batch in batches:
            flat, ends = _flat(batch.column(1))
            bits = np.zeros((batch.num_rows, PARITY_BITS // 8), np.uint8)
            for k, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
                cells = (words.mixed(flat[a:b] ^ PLACE) % np.uint64(PARITY_BITS)).astype(np.int64)
                bits[k] = np.packbits((np.bincount(cells, minlength=PARITY_BITS) & 1).astype(np.uint8))
            table = bits.view(np.int64)
            yield batch_of(node=batch.column(0), **{name: pa.array(np.ascontiguousarray(table[:, k])) for k, name in enumerate(PARITIES)})

    schema = ", ".join(f"{name} long" for name in PARITIES)
    return sets.select("node", "elements").mapInArrow(rows, f"node long, {schema}")


def _alike(one: str, other: str, percent: int):
    """Whether sizes and parity bits of two members allow a link."""
    bits = " + ".join(f"bit_count({one}.{p} ^ {other}.{p})" for p in PARITIES)
    return _may_link(one, other) & F.expr(f"{bits} <= ({one}.size + {other}.size) * {100 - percent} div {100 + percent}")


def _dealt(members: DataFrame, meeting: str) -> DataFrame:
    """Members with the number of chunks of their signature, sized by the members for which ``meeting`` holds."""
    sizes = members.groupBy("signature").agg(F.ceil(F.count_if(F.expr(meeting)) / CHUNK).cast("int").alias("chunks"))
    own = F.expr("cast(pmod(xxhash64(node, 7), chunks) as int)")
    return members.join(sizes.where("chunks > 0"), "signature").withColumn("own", own)


def _across(members: DataFrame, parities: DataFrame, percent: int) -> DataFrame:
    """All pairs of members of one signature that lie in different components and may link.

    The members outside their signature's largest component meet all others; each chunk of
    them by a key of its own.
    """
    largest = members.groupBy("signature", "component").count().groupBy("signature")
    main = largest.agg(F.max_by("component", F.struct("count", "component")).alias("main"))
    marked = members.join(main, "signature").withColumn("outside", F.expr("component <> main"))
    dealt = _dealt(marked, "outside").join(parities, "node")
    one = dealt.where("outside").selectExpr("signature", "own as chunk", "component as cx", f"{CARRIED} x")
    other = dealt.selectExpr("signature", "explode(sequence(0, chunks - 1)) as chunk", "component as cy", "outside", f"{CARRIED} y")
    once = F.expr("cx <> cy and (not outside or x.node < y.node)")
    pairs = one.join(other, ["signature", "chunk"]).where(once & _alike("x", "y", percent))
    return pairs.select(*_pair("x", "y")).distinct()


def _all_pairs(members: DataFrame, parities: DataFrame, percent: int) -> DataFrame:
    """All pairs of members of one signature that may link; each two chunks of members meet by a key of their own."""
    dealt = _dealt(members, "true").join(parities, "node")
    one = dealt.selectExpr("signature", "own as low", "explode(sequence(own, chunks - 1)) as high", f"{CARRIED} x")
    other = dealt.selectExpr("signature", "explode(sequence(0, own)) as low", "own as high", f"{CARRIED} y")
    pairs = one.join(other, ["signature", "low", "high"]).where("low < high or x.node < y.node").where(_alike("x", "y", percent))
    return pairs.select(*_pair("x", "y")).distinct()


def _without_later(candidates: DataFrame, later: DataFrame) -> DataFrame:
    """Candidates that are no later copies; only where those are many do the candidates move."""
    gone = later.select("doc_id", *SAME).distinct()
    if later.count() <= MOST_BROADCAST:
        gone = F.broadcast(gone)
    return candidates.join(gone, ["doc_id", *SAME], "left_anti")


def _prepared(docs: DataFrame, width: int, percent: int, id_column: str, text_column: str) -> tuple[DataFrame, ...]:
    """Rows with their sets' sizes, rows whose set another id stands for, sets, members of signatures, outlines.

    What nothing reads any more is deleted as soon as what it led to is written.
    """
    pairs = ids_and_texts(docs, id_column, text_column)
    cells = Cells(character_total(pairs) // BYTES_A_SHINGLE)
    with_chunks = staged(_measured(pairs, width, cells), "measured")
    measured = staged(with_chunks.where("chunk is null").select("doc_id", *SAME), "sizes")
    chunks = with_chunks.where("chunk is not null").select("chunk", "segment", "cells", "owners")
    shared = staged(mostly_shared(chunks, cells, SAME, "n_shingles", percent), "shared")
    discard(with_chunks)
    with_sets = staged(_candidates(pairs, shared, width), "candidates")
    discard(shared)

    filled = measured.where("doc_id is not null and n_shingles > 0")
    classes = filled.groupBy(*SAME).agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"))
    copied = staged(classes.where("copies > 1").select(*SAME, "node"), "copied")
    later = filled.select("doc_id", *SAME).join(copied, SAME).where("doc_id > node").select("doc_id", *SAME, "node")
    later = staged(later, "later")

    sets = _without_later(with_sets, later).select(F.col("doc_id").alias("node"), "elements")
    before = with_sets
    for _ in range(WEIGHINGS):
        sets = staged(sets, "sets")
        discard(before)
        before = sets
        total = sets.agg(F.sum(F.size("elements"))).first()[0] or 0
        sets = _weighed(sets, percent, 4 * total)
    sets = bucketed(sets, "sets", "node")
    discard(before)
    entries = bucketed(_entries(sets, percent), "entries", "signature")
    several = staged(_different_groups(entries), "several")
    members = staged(entries.join(several, "signature").where("most >= least").drop("least").distinct(), "members")
    discard(entries, several, copied)

    outlines = bucketed(_outlines(sets.join(members.select("node").distinct(), "node", "left_semi")), "outlines", "node")
    return measured, later, sets, members, outlines


def _parities_of(members: DataFrame, sets: DataFrame) -> DataFrame:
    """The parity bits of the sets that are members."""
    return staged(_parities(sets.join(members.select("node").distinct(), "node", "left_semi")), "parities")


def jaccard_links(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(a, b) for each link of different sets, a < b; of the ids with equal sets the smallest stands for all."""
    *_, sets, members, outlines = _prepared(docs, width, percent, id_column, text_column)
    return _linked(_plausible(_all_pairs(members, _parities_of(members, sets), percent), outlines, percent), sets, percent).distinct()


def link_counts(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(node, n_links) of each id that ``jaccard_links`` names: with how many others it links."""
    links = staged(jaccard_links(docs, width, percent, id_column, text_column), "links")
    ends = links.selectExpr("a as node").unionAll(links.selectExpr("b as node"))
    return ends.groupBy("node").agg(F.count("*").alias("n_links"))


def jaccard_components(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row: its set's size, and the smallest id that links reach."""
    measured, later, sets, members, outlines = _prepared(docs, width, percent, id_column, text_column)
    spark, links, rest = docs.sparkSession, None, members
    for turn in range(HUB_ROUNDS):

        def linked(rest: DataFrame = rest, links: DataFrame | None = links, turn: int = turn) -> DataFrame:
            found = _linked(_plausible(_hub_pairs(rest, turn), outlines, percent), sets, percent)
            return found if links is None else links.unionAll(found)

        more = staged_alone(linked, spark, "links")
        still = staged_alone(lambda rest=rest, links=more: _open(_grouped(rest, components(links))), spark, "members")
        discard(rest, *([] if links is None else [links]))
        links, rest = more, still
    across = _across(rest, _parities_of(rest, sets), percent)
    links = links.unionAll(_linked(_plausible(across, outlines, percent), sets, percent))
    # An id of several rows with different texts is one vertex.
    links = links.unionAll(later.select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    labels = components(links).select(F.col("node").alias("doc_id"), F.col("component").alias("component_id"))
    result = measured.select("doc_id", "n_shingles").join(labels, "doc_id", "left")
    return result.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def without_similar(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id.

    Rows of one id stay or go together; rows without an id stay.
    """

    def others() -> DataFrame:
        found = jaccard_components(docs, width, percent)
        return found.where("component_id <> doc_id").select("doc_id").distinct()

    gone = staged_alone(others, docs.sparkSession, "similar")
    return docs.join(gone, "doc_id", "left_anti")
