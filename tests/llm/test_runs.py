"""Periodic runs against a plain search of every period."""

import random

import brute
import numpy as np
import pytest

from shelfwise.llm import periodic_runs as module
from shelfwise.llm.number_transform import PRIME, backward, correlation, forward
from shelfwise.llm.periodic_runs import maximal_runs, periodic_runs, run_digests, with_looped_tails

COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_transform_is_exact():
    rng = np.random.default_rng(4)
    for size in (2, 4, 8, 64, 1024):
        x = rng.integers(0, PRIME, (size, 3), dtype=np.uint64)
        assert (backward(forward(x)) == x).all()
    for length in (1, 2, 4, 16):
        window, block = (rng.integers(0, PRIME, (n, 5), dtype=np.uint64) for n in (2 * length, length))
        got = correlation(window, block)[:length]
        for shift in range(length):
            for c in range(5):
                assert got[shift, c] == sum(int(a) * int(b) for a, b in zip(window[shift : shift + length, c], block[:, c])) % PRIME


def random_document(rng):
    kinds = rng.choice([1, 2, 2, 3, 20])
    w = [rng.randrange(kinds) for _ in range(rng.randrange(0, 120))]
    if rng.random() < 0.6:
        unit = [rng.randrange(kinds) for _ in range(rng.randrange(1, 20))]
        at = rng.randrange(len(w) + 1)
        w[at:at] = (unit * 12)[: rng.randrange(1, 12 * len(unit) + 1)]
    return w


def test_runs_of_many_documents(monkeypatch):
    rng = random.Random(1)
    for turn in range(60):
        monkeypatch.setattr(module, "AT_ONCE", 64 if turn % 2 else 1 << 19)
        documents = [random_document(rng) for _ in range(rng.randrange(1, 6))]
        first = np.cumsum([0, *map(len, documents)])
        want = [(k, *run) for k, w in enumerate(documents) for run in brute.periodic_runs(w)]
        assert maximal_runs(np.array(sum(documents, []), np.int64), first) == want


@pytest.mark.parametrize("unit", [[0], [0, 1], list(range(300))])
def test_one_run_of_a_long_text(unit):
    w = (unit * 100_000)[:100_000]
    assert maximal_runs(np.array(w), np.array([0, len(w)])) == [(0, 0, 100_000, len(unit))]


def test_digests(docs, odd_rows, prose):
    rng = random.Random(9)
    rows = odd_rows + [(100 + k, " ".join(f"w{x}" for x in random_document(rng))) for k in range(150)]
    rows += [(300 + k, prose(rng.randrange(4, 400), 60)) for k in range(60)]
    rows += [(400, "a b " * 30 + "\n c\tc c c c c c"), (401, "x " * 5), (402, "x " * 6), (403, "p q r " * 4 + "p"), (403, "p q r " * 4 + "p")]
    got = run_digests(periodic_runs(with_looped_tails(docs(rows).selectExpr("*", "1 as runs", "2 as W", "3 as n_words"))))
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == sorted(brute.run_digests(i, t) for i, t in rows)
    assert sum(1 for i, _ in rows if i is not None and brute.zlib.crc32(str(i).encode()) % 10 == 0) > 5


def test_digests_of_documents(spark, small):
    table = spark.read.parquet(f"{small}/documents.parquet").where("length(text) < 20000")
    got = run_digests(periodic_runs(with_looped_tails(table)))
    assert sorted(map(tuple, got.collect())) == sorted(brute.run_digests(r.doc_id, r.text) for r in table.collect())


def test_runs_and_collapsed_text(docs):
    text = "say it it it it it it it twice, a b a b a b a b end"
    row = periodic_runs(docs([(None, text)])).first()
    assert row.doc_id is None and row.n_words == 18
    assert [tuple(r) for r in row.runs] == [(1, 7, 1), (9, 8, 2)]
    assert row.collapsed == "say it twice, a b end"
    assert with_looped_tails(docs([(None, text)])).first().text == text
    assert periodic_runs(docs([])).count() == 0


def test_a_very_long_text(docs):
    unit = " ".join(f"w{k}" for k in range(1000))
    row = periodic_runs(docs([(1, f"{unit} " * 400 + "end"), (2, "z" * 3_000_000)])).orderBy("doc_id").collect()
    assert [tuple(r) for r in row[0].runs] == [(0, 400_000, 1000)] and row[0].collapsed == f"{unit} end"
    assert row[1].n_words == 1 and row[1].runs == [] and len(row[1].collapsed) == 3_000_000
