"""Similarity join, substring removal, decontamination and components, against plain versions."""

import random

import brute
import numpy as np
import pytest

from shelfwise.llm import dealt, jaccard_join, sketch
from shelfwise.llm.dealt import Cells, Chunk, mostly_shared
from shelfwise.llm.decontamination import contaminated, without_contaminated
from shelfwise.llm.jaccard_join import Bands, _different_groups, jaccard_components, jaccard_links, link_counts, signatures, without_similar
from shelfwise.llm.links import components
from shelfwise.llm.sketch import Sketch, packed, unpacked
from shelfwise.llm.staging import forget
from shelfwise.llm.substring_dedup import remove_repeated_windows


def changed(text, n, rng):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture
def family(prose):
    """Texts with copies near and exact, at and around the threshold, and a shared passage."""
    rng = random.Random(3)
    passage = prose(60)
    rows = []
    for size in (5, 9, 12, 25, 40, 80, 150, 400):
        base = prose(size)
        rows += [base, base, *[changed(base, n, rng) for n in (1, 1, 2, 3, 5, 8)]]
        rows += [f"{base} {prose(n)}" for n in (1, size // 5 + 1)]
    rows += [f"{prose(40)} {passage} {prose(40)}" for _ in range(12)]
    return list(enumerate(rows))


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(5)
    bands = Bands(80)
    for _ in range(400):
        size = int(rng.integers(4, 600))
        base = rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2)
        gone = int(rng.integers(0, size // 9 + 1))
        added = rng.integers(0, 2**63, int(rng.integers(0, size // 9 + 1)), dtype=np.uint64) * np.uint64(2)
        other = np.concatenate([base[gone:], added])
        both = size - gone
        if 100 * both >= 80 * (size + len(other) - both) and (gone or len(added)):
            assert set(signatures(np.sort(base), bands).tolist()) & set(signatures(np.sort(other), bands).tolist())


def test_jaccard_components(docs, family, odd_rows, spark):
    rows = family + [(1000 + i, t) for i, t in odd_rows]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs(rows)).collect()}
    assert got == brute.jaccard_components(rows)
    forget(spark)


def test_jaccard_on_documents(spark, small):
    table = spark.read.parquet(f"{small}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(table).collect()}
    assert got == brute.jaccard_components([(r.doc_id, r.text) for r in table.collect()])
    forget(spark)


def test_jaccard_ids_missing_and_repeated(docs, prose):
    a, b = prose(50), prose(50)
    rows = [(None, a), (1, a), (2, b), (2, a), (3, b)]
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in jaccard_components(docs(rows)).collect())
    # Row 2 stands for both texts and so ties 1 and 3 together.
    assert got == [(-1, -1), (1, 1), (2, 1), (2, 1), (3, 1)]
    kept = without_similar(docs([(None, a), (1, a), (4, a), (5, b)]))
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 5]
    assert kept.columns == docs([]).columns


def test_signatures_of_repeated_members_stay(spark):
    rows = [(sig, node, 10, 12, 0) for sig, nodes in ((100, (1, 5, 9)), (200, (1, 7, 9)), (300, (1, 5, 9)), (400, (4, 4))) for node in nodes] * 2
    entries = spark.createDataFrame(rows, "signature long, node long, size int, most int, odd int")
    assert sorted((r.signature, r.least) for r in _different_groups(entries).collect()) == [(100, 10), (200, 10)]
    # An id of two texts: what one of them may link with, the other may not.
    rows = [(sig, 1, size, size + 2, 0) for sig, size in ((500, 10), (600, 30))] + [(sig, 5, 30, 32, 0) for sig in (500, 600)]
    entries = spark.createDataFrame(rows, "signature long, node long, size int, most int, odd int")
    assert sorted(r.signature for r in _different_groups(entries).collect()) == [500, 600]


def test_jaccard_rows_that_stand_twice(docs, family, spark):
    got = [(r.doc_id, (r.n_shingles, r.component_id)) for r in jaccard_components(docs(family * 2)).collect()]
    assert len(got) == 2 * len(family) and dict(got) == brute.jaccard_components(family)
    forget(spark)


def test_jaccard_links(docs, family, prose, spark, monkeypatch):
    """Every link of different texts, also inside a group that a hub holds together and that takes several chunks."""
    monkeypatch.setattr(jaccard_join, "CHUNK", 4)
    rng, base = random.Random(12), prose(200)
    rows = family + [(500 + k, changed(base, 2, rng)) for k in range(20)]
    first = {}
    for i, text in rows:
        first.setdefault(brute.shingles(text), i)
    alike = lambda x, y: 100 * len(x & y) >= 80 * len(x | y)
    want = {tuple(sorted((first[x], first[y]))) for x in first for y in first if x and first[x] < first[y] and alike(x, y)}
    got = [(r.a, r.b) for r in jaccard_links(docs(rows)).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len([a for a, _ in got if a >= 500]) == 190
    counts = {r.node: r.n_links for r in link_counts(docs(rows)).collect()}
    assert counts == {i: sum(i in pair for pair in want) for pair in want for i in pair}
    forget(spark)


def test_jaccard_leaves_lone_sets_out_when_a_sketch_is_full(docs, prose, spark, monkeypatch):
    """More shingles than a sketch may have cells: texts without a partner still get no signatures."""
    monkeypatch.setattr(sketch, "MAX_BITS", 12)
    rng = random.Random(4)
    rows = [(i, prose(60)) for i in range(300)]
    rows += [(1000 + i, changed(rows[i][1], 1, rng)) for i in range(3)]
    _, _, sets, members, _ = jaccard_join._prepared(docs(rows), 5, 80, "doc_id", "text")
    assert sets.count() < 30 and {r.node for r in members.select("node").collect()} >= {0, 1, 2, 1000, 1001, 1002}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs(rows)).collect()}
    assert got == brute.jaccard_components(rows) and got[1000][1] == 0
    forget(spark)


def test_lone_hashes_of_sets_in_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(dealt, "SETS", 7)
    cells, rng = Cells(1 << 26), np.random.default_rng(8)
    assert cells.runs > 1
    pool = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(pool, size), rng.integers(0, 2**64, new, dtype=np.uint64)])) for size in (0, 1, 40, 200) for new in (0, 1, 30, 120)] * 2
    sets += [np.unique(rng.integers(0, 2**64, 50, dtype=np.uint64)) for _ in range(40)] + [pool[:1]] * 20
    names, chunk = np.array([(len(own), k) for k, own in enumerate(sets)], np.int64), Chunk(cells)
    rows = [r for part in [*chunk.add(sets[:30], names[:30]), *chunk.add(sets[30:], names[30:]), *chunk.rows()] for r in part.to_pylist()]
    assert len({r["chunk"] for r in rows}) > 5
    table = spark.createDataFrame([(r["chunk"], r["segment"], r["cells"], r["owners"]) for r in rows], dealt.SCHEMA)
    got = sorted(r.k for r in mostly_shared(table, cells, ["size", "k"], "size", 80).collect())
    lower = [own[own < np.uint64(1 << 63)] for own in sets]
    places, times = np.unique(np.concatenate([own >> np.uint64(63 - cells.bits) for own in lower]), return_counts=True)
    single = set(places[times == 1].tolist())
    lone = [sum(c in single for c in (own >> np.uint64(63 - cells.bits)).tolist()) for own in lower]
    assert got == [k for k, own in enumerate(sets) if len(own) and 100 * (len(own) - lone[k]) >= 80 * len(own)]
    assert 0 < len(got) < len(sets) - 30


def test_chunks_without_hashes_in_the_lower_half(spark):
    cells = Cells(10)
    rows = []
    for sets in ([np.empty(0, np.uint64)], [np.array([1 << 63], np.uint64)]):
        chunk = Chunk(cells)
        rows += [r for part in [*chunk.add(sets, np.array([(len(sets[0]), 5)])), *chunk.rows(), *chunk.rows()] for r in part.to_pylist()]
    assert [r["segment"] for r in rows] == [dealt.NAMES] * 2
    table = spark.createDataFrame([(r["chunk"], r["segment"], r["cells"], r["owners"]) for r in rows], dealt.SCHEMA)
    assert [tuple(r) for r in mostly_shared(table, cells, ["size", "k"], "size", 80).collect()] == [(1, 5)]


def test_empty_tables(docs, spark):
    none = docs([])
    assert jaccard_components(none).count() == 0
    assert remove_repeated_windows(none).count() == 0
    items = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(none, items).count() == 0
    assert contaminated(docs([(1, "a b c d e f")]), items).count() == 0


def test_removed_windows(docs, family, odd_rows, prose):
    looped = " ".join(["again and again"] * 30)
    rows = family + [(1000 + i, t) for i, t in odd_rows] + [(2000, looped), (2001, prose(19)), (2002, prose(20))]
    out = remove_repeated_windows(docs(rows))
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out.collect())
    assert got == brute.repeated_windows(rows)
    texts = {r.doc_id: (r.text, r.n_removed, r.n_words) for r in out.collect()}
    for i, text in rows:
        after, removed, n = texts[i]
        assert after == text if not removed else len(brute.words(after)) == n - removed


def test_windows_of_ids_missing_and_names_taken(docs, prose, spark):
    a = prose(30)
    out = remove_repeated_windows(docs([(None, a), (1, a), (1, a), (2, a)]).selectExpr("*", "1 as n_removed", "2 as Owned"))
    assert sorted((r.doc_id or -1, r.n_removed) for r in out.collect()) == [(-1, 0), (1, 0), (1, 0), (2, 30)]
    assert out.columns.count("n_removed") == 1 and "Owned" in out.columns


def test_sketch_never_misses():
    rng = np.random.default_rng(2)
    items = rng.integers(0, 2**63, 30_000, dtype=np.uint64)
    sketch = Sketch(16, 2)
    for part in np.array_split(np.concatenate([items, items[:5000]]), 7):
        sketch.add(part)
    for depth in range(2):
        cells = (items[:5000] >> np.uint64(32 * depth)) & np.uint64((1 << 16) - 1)
        bits = np.unpackbits(sketch.twice[depth], bitorder="little")
        assert bits[cells.astype(int)].all()
    for share in (0, 0.001, 0.05, 0.9):
        bitmap = np.packbits(rng.random(1 << 15) < share, bitorder="little")
        assert (unpacked(packed(bitmap), len(bitmap)) == bitmap).all()


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 130)}, 200: 200, 201: 200}


def test_contaminated(docs, prose, spark):
    rng = random.Random(11)
    items = [(k, prose(n)) for k, n in enumerate((3, 5, 8, 15, 30, 31, 48, 59, 64))]
    items += [(20, None), (21, ""), (22, items[4][1])]
    rows = [(k, f"{prose(rng.randrange(80))} {text} {prose(50)}") for k, text in items if text]
    rows += [(100 + k, f"{prose(30)} {changed(items[8][1], 1, rng)} {prose(30)}") for k in range(6)]
    rows += [(200 + k, f"{prose(9)} {changed(items[7][1], 4, rng)}") for k in range(6)]
    rows += [(300, items[5][1].upper()), (301, prose(400)), (302, None), (303, ""), (None, items[6][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated(docs(rows), bench).collect()}
    want = {(i, j) for i, t in rows for j, item in items if len(brute.words(item)) >= 5 and t and brute.has_item(t, item)}
    assert got == want and (None, 6) in got and (300, 5) in got and (0, 0) not in got
    kept = {r.doc_id for r in without_contaminated(docs(rows), bench).collect()}
    assert kept == {i for i, _ in rows} - {i for i, _ in got}


def test_contaminated_by_edited_copies(docs, prose, spark):
    """Words missing or changed at either end or inside, up to what the similarity allows, against all stretches."""
    rng = random.Random(17)
    items = [(n, prose(n)) for n in (16, 20, 32, 33, 64, 65, 130, 300)] + [(900, "again and " * 20), (901, "a b c d e f a b c d e f x y z z z")]
    texts = []
    for n, item in items[:8]:
        w = item.split()
        for k in (1, 2, 3, n // 13, n // 10):
            new, at = [f"new{rng.randrange(10**6)}" for _ in range(k)], rng.randrange(5, n - k)
            cuts = [w[k:], w[:-k], w[: n // 2] + w[n // 2 + k :], w[:at] + w[at + k :]]
            cuts += [new + w[k:], w[:-k] + new, w[:at] + new + w[at + k :], w[:at] + new + w[at:]]
            spread = list(w)
            for p in rng.sample(range(n), max(k // 2, 1)):
                spread[p] = new[0]
            texts += [" ".join(cut) for cut in [*cuts, spread]]
    texts += ["again and " * k for k in (2, 3, 19, 45)] + ["a b c d e f a b c d e f x y z", "q " + items[9][1] + " z z z z"]
    rows = [(k, text if k % 3 else f"{prose(20)} {text} {prose(15)}") for k, text in enumerate(texts)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated(docs(rows), bench).collect()}
    want = {(i, j) for i, t in rows for j, item in items if brute.has_item(t, item)}
    assert got == want and len(want) > 100


def test_contaminated_documents(spark, small):
    table, bench = (spark.read.parquet(f"{small}/{name}.parquet") for name in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in contaminated(table, bench).collect()}
    plain = {r.doc_id: " ".join(w.decode() for w in brute.words(r.text, lower=True)) for r in table.collect()}
    for item in bench.collect():
        want = " ".join(w.decode() for w in brute.words(item.text, lower=True))
        assert {(i, item.item_id) for i, t in plain.items() if f" {want} " in f" {t} "} <= got


def test_fingerprints_alone_find_most(docs, prose, spark):
    """Recall of the windows without the supplement: unchanged copies all, copies edited up to the similarity over 0.9."""
    rng = random.Random(23)
    items = [(n, prose(n)) for n in (15, 20, 27, 32, 33, 48, 64, 65, 100, 130, 300)]
    rows, exact = [], set()
    for n, item in items:
        w = item.split()
        for k in range(12):
            exact.add((len(rows), n))
            rows.append((len(rows), f"{prose(rng.randrange(90))} {item} {prose(rng.randrange(40))}"))
            many = rng.randrange(1, max(2, n // 9))
            at = rng.randrange(n - many + 1)
            new = [f"new{rng.randrange(10**6)}" for _ in range(many)]
            edits = [w[many:], w[:-many], w[:at] + w[at + many :], w[:at] + new + w[at + many :], w[:at] + new + w[at:], new + w[many:]]
            rows.append((len(rows), f"{prose(rng.randrange(90))} {' '.join(edits[k % 6])} {prose(rng.randrange(40))}"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {(i, j) for i, t in rows for j, item in items if brute.has_item(t, item)}
    alone = {(r.doc_id, r.item_id) for r in contaminated(docs(rows), bench, supplement=False).collect()}
    whole = {(r.doc_id, r.item_id) for r in contaminated(docs(rows), bench).collect()}
    assert whole == want and exact <= alone <= want
    assert len(want) > 180 and len(alone) >= 0.9 * len(want), len(alone) / len(want)
    assert len(alone - exact) >= 0.85 * len(want - exact), len(alone - exact) / len(want - exact)
