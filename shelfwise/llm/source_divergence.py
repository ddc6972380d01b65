"""How far sources of a language differ in their words, by run-length columns.

Terms are runs of letters (A-Z in lower case) and characters beyond ASCII. A language
keeps the V terms that stand in at least ``min_docs`` of its documents. A group is a
language and a source; with N its kept terms' total, a term that occurs c times there
has p = 1 + floor(SCALE * (c + 1) / (N + V)). The divergence of p from q is
f = floor((p - q)^2 / q). All is integer arithmetic.

Method. A term's counts in all sources of its language are a row, a source's counts a
column. Rows are ordered by their counts, which clusters equal ones: equal rows
become one row that stands for many terms, and a column a few runs of equal counts, zeros
foremost. For each two sources the boundaries of their columns' runs are intersected;
between two boundaries f is worked out once and multiplied by the run's length.

Work is dealt by blocks of that order, and by chunks of ``COLUMNS`` sources where a
language has more, so no task holds a whole vocabulary. Counts are added up within a
task before the shuffle, in tables of ``HELD`` rows at most; a hot term or source sends
as many rows as there are tasks.

Range: exact for up to 2^53 occurrences and 2^32 kept terms in a language: a sum of f is at
most (SCALE + 1) * (SCALE + V) + SCALE + V, which 64 bits hold.

Cases: null text, language and source are ''; each row is a document of its own, repeated
rows and ids too; a text without terms, however long, still makes its group occur; a
language that keeps no term has pairs of value 0; a source that is alone in its language
has no pairs; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.columns import batch_of
from shelfwise.llm.staging import discard, staged
from shelfwise.llm.word_arrays import LETTERS, LetterPiece
from shelfwise.llm.words import pieces

SCALE = 1_000_000_000
MIN_DOCS = 3
TOP_TERMS = 200
PIECE_BYTES = 4 << 20
#: Rows of counts that a task holds before it passes them on.
HELD = 400_000
#: Different rows of counts in a block, and sources whose pairs one task works out.
BLOCK_ROWS = 100_000
COLUMNS = 64

COUNTS = ["lang", "source", "term"]


def _added(tables: list[pa.Table]) -> pa.Table:
    both = pa.concat_tables(tables).group_by(COUNTS).aggregate([("n", "sum"), ("docs", "sum")])
    return both.rename_columns([*COUNTS, "n", "docs"]).cast(tables[0].schema)


def _table(lang: pa.Array, source: pa.Array, term: pa.Array, n: np.ndarray, docs: np.ndarray) -> pa.Table:
    return pa.table({"lang": lang, "source": source, "term": term, "n": pa.array(n, pa.int64()), "docs": pa.array(docs, pa.int64())})


def _piece_counts(piece: LetterPiece, group: np.ndarray) -> tuple[np.ndarray, ...]:
    """(group, code, occurrences, documents) of a piece, and the codes' terms."""
    codes, terms = piece.codes()
    kinds = max(len(terms), 1)
    document = np.repeat(np.arange(len(piece.rows)), np.diff(piece.first))
    pair, n = np.unique(document * kinds + codes, return_counts=True)
    key = group[pair // kinds] * kinds + pair % kinds
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
    docs = np.diff(np.append(starts, len(key)))
    return key[starts] // kinds, key[starts] % kinds, np.add.reduceat(n, starts) if len(starts) else n, docs, terms


def _parts(piece: LetterPiece, raw: np.ndarray) -> Iterator[LetterPiece]:
    """A long document as pieces of its own, cut between words."""
    outside = np.flatnonzero(~LETTERS[raw])
    start = 0
    while start < len(raw):
        end = min(start + PIECE_BYTES, len(raw))
        if end < len(raw):
            k = int(np.searchsorted(outside, end))
            end = int(outside[k]) if k < len(outside) else len(raw)
        yield LetterPiece(raw[start:end], np.array([0, end - start]), range(1))
        start = end


def _batch_counts(batch: pa.RecordBatch) -> Iterator[pa.Table]:
    """Counts of each piece of a batch (lang, source, text)."""
    lang, source = (pa.DictionaryArray.from_arrays(*_coded(batch.column(k))) for k in (0, 1))
    groups = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
    for piece in pieces(batch.column(2), limit=PIECE_BYTES, kind=LetterPiece):
        own = groups[piece.rows.start : piece.rows.stop]
        if len(piece.data) > 2 * PIECE_BYTES:  # one long document: its parts are one document
            found = []
            for part in _parts(piece, piece.data):
                _, code, n, _, terms = _piece_counts(part, np.zeros(1, np.int64))
                found.append(pa.table({"term": terms.take(pa.array(code)), "n": pa.array(n, pa.int64())}))
            whole = pa.concat_tables(found).group_by("term").aggregate([("n", "sum")])
            group, terms, n, docs = np.repeat(own, len(whole)), whole["term"].combine_chunks(), whole["n_sum"].to_numpy(), np.ones(len(whole))
        else:
            group, code, n, docs, terms = _piece_counts(piece, own)
            terms = terms.take(pa.array(code))
        at = group // len(source.dictionary), group % len(source.dictionary)
        names = lang.dictionary.take(pa.array(at[0])), source.dictionary.take(pa.array(at[1]))
        yield _table(*names, terms.cast(pa.string()), n, docs)


def _coded(column: pa.Array) -> tuple[pa.Array, pa.Array]:
    encoded = column.dictionary_encode()
    return encoded.indices, encoded.dictionary.cast(pa.string())


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, added up within each task."""

    def rows(batches):
        held: list[pa.Table] = []
        for batch in batches:
            for table in _batch_counts(batch):
                held.append(table)
                if sum(map(len, held)) > HELD:
                    held = [_added(held)]
                    if len(held[0]) > HELD // 2:
                        yield from held.pop().to_batches()
        if held:
            yield from _added(held).to_batches()

    return docs.select("lang", "source", "text").mapInArrow(rows, "lang string, source string, term string, n long, docs long")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def _kept_terms(texts: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, total, row): kept terms with their counts by source, one shuffle for both sums."""
    counts = term_counts(texts)
    dealt = counts.repartition("lang", "term").groupBy(*COUNTS).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = dealt.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("row")
    )
    return by_term.where(F.col("docs") >= min_docs).select("lang", "term", "total", "row")


def _groups(texts: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, n, v, place, total): every group that occurs; place: its number in its language."""
    present = texts.groupBy("lang", "source").agg(F.lit(0).cast("long").alias("n"))
    counted = kept.select("lang", F.explode("row").alias("cell")).groupBy("lang", F.col("cell.source").alias("source"))
    both = present.unionByName(counted.agg(F.sum("cell.n").alias("n"))).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("total"))
    along = Window.partitionBy("lang").orderBy("source")
    placed = both.withColumn("place", F.row_number().over(along) - 1)
    joined = placed.join(sizes, "lang", "left")
    return joined.select("lang", "source", "n", F.coalesce("v", F.lit(0)).alias("v"), "place", F.coalesce("total", F.lit(0)).alias("total"))


def _exact(count: Column, total: Column, v: Column) -> Column:
    """p of a count, in decimals, which hold every product exactly."""
    share = (F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)")).cast("decimal(38,0)")
    return F.lit(1).cast("long") + F.call_function("div", share, (total + v).cast("decimal(38,0)"))


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), three decimal digits at a time so that nothing overflows."""
    rest = counts + 1
    whole, rest = rest // total, rest % total
    for _ in range(3):
        rest = rest * 1000
        whole, rest = whole * 1000 + rest // total, rest % total
    return whole + 1


def run_sum(ends: tuple[np.ndarray, np.ndarray], values: tuple[np.ndarray, np.ndarray]) -> int:
    """The sum of f over two columns of runs (where each ends, its value): boundaries intersected, f times run length."""
    bounds = np.union1d(*ends)
    p, q = (v[np.searchsorted(e, bounds)] for e, v in zip(ends, values, strict=True))
    apart = (p - q) ** 2 // q
    return int((apart * np.diff(bounds, prepend=0)).sum())


def _columns(rows: pa.Table, names: np.ndarray, n: np.ndarray, v: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each source's column as runs (where each ends, its share), over rows in order."""
    ends = np.cumsum(rows["terms"].to_numpy())
    cells = rows["row"].combine_chunks()
    flat = cells.flatten()
    at = np.repeat(np.arange(len(cells)), np.diff(cells.offsets.to_numpy()))
    places = {name: k for k, name in enumerate(names)}
    sources = flat.field("source").dictionary_encode()
    place = np.array([places[s] for s in sources.dictionary.to_pylist()], np.int64)[sources.indices.to_numpy()]
    order = np.argsort(place, kind="stable")
    place, at, counts = place[order], at[order], flat.field("n").to_numpy()[order]
    found = []
    for k, (a, b) in enumerate(zip(*(np.searchsorted(place, np.arange(len(names)), side) for side in ("left", "right")), strict=True)):
        column = np.zeros(len(ends), np.int64)
        column[at[a:b]] = counts[a:b]
        last = np.append(np.flatnonzero(column[1:] != column[:-1]), len(column) - 1)
        found.append((ends[last], shares(column[last], int(n[k]) + v)))
    return found


def _pair_sums(key: tuple, rows: pa.Table, groups: pa.Table) -> pa.Table:
    """f summed over one block's terms, for a chunk of sources against all of the language."""
    lang, _, chunk = (k.as_py() for k in key)
    groups = groups.sort_by("place")
    names = groups["source"].to_pylist()
    own = range(chunk * COLUMNS, min((chunk + 1) * COLUMNS, len(names)))
    pairs = [(a, b) for a in own for b in range(len(names)) if a != b]
    values = [0] * len(pairs)
    if len(rows):
        rows = rows.sort_by("place")  # the order of the block
        runs = _columns(rows, np.array(names, object), groups["n"].to_numpy(), groups["v"][0].as_py())
        values = [run_sum((runs[a][0], runs[b][0]), (runs[a][1], runs[b][1])) for a, b in pairs]
    return pa.table({
        "lang": pa.array([lang] * len(pairs), pa.string()),
        "source": pa.array([names[a] for a, _ in pairs], pa.string()),
        "item": pa.array([names[b] for _, b in pairs], pa.string()),
        "value": pa.array(values, pa.int64()),
    })


def _blocks(kept: DataFrame) -> DataFrame:
    """(lang, row, terms, block, place): different rows of counts in their order, and how many terms have each."""
    different = staged(kept.groupBy("lang", "row").agg(F.count("*").alias("terms")), "rows")
    n_blocks = max(1, math.ceil(different.count() / BLOCK_ROWS))
    ordered = different.repartitionByRange(n_blocks, "lang", "row").sortWithinPartitions("lang", "row")
    blocks = staged(ordered.select("*", F.spark_partition_id().alias("block"), F.monotonically_increasing_id().alias("place")), "blocks")
    discard(different)
    return blocks


def pair_divergence(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): each group's divergence from every other source of its language."""
    blocks = _blocks(kept)
    chunks = groups.groupBy("lang").agg(F.floor(F.max("place") / COLUMNS).cast("int").alias("last"))
    which = blocks.select("lang", "block").distinct()
    # A language without terms has one block, without rows.
    which = chunks.join(which, "lang", "left").select("lang", F.coalesce("block", F.lit(-1)).alias("block"), F.explode(F.sequence(F.lit(0), "last")).alias("chunk"))
    heads = which.join(groups.select("lang", "source", "n", "v", "place"), "lang")
    rows = blocks.join(chunks, "lang").withColumn("chunk", F.explode(F.sequence(F.lit(0), "last"))).drop("last")
    key = ["lang", "block", "chunk"]
    sums = rows.groupBy(*key).cogroup(heads.groupBy(*key)).applyInArrow(_pair_sums, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_divergence(kept: DataFrame, groups: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, item, value, rank): each group's terms that are commoner there than in its language."""
    cells = kept.select("lang", "term", "total", F.explode("row").alias("cell"))
    cells = cells.select("lang", F.col("cell.source").alias("source"), F.col("term").alias("item"), F.col("cell.n").alias("count"), F.col("total").alias("all"))
    known = cells.join(groups, ["lang", "source"])
    known = known.withColumn("p", _exact(F.col("count"), F.col("n"), F.col("v"))).withColumn("q", _exact(F.col("all"), F.col("total"), F.col("v")))
    # Up to SCALE + 1 squared: within 64 bits.
    value = F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("q"))
    above = known.where("p > q").select("lang", "source", "item", value.alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def divergence_audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank of every group's items."""
    texts = _texts(docs)
    kept = staged(_kept_terms(texts, min_docs), "terms")
    groups = staged(_groups(texts, kept), "groups")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_divergence(kept, groups).withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    terms = term_divergence(kept, groups, top).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(terms.select(*columns))
