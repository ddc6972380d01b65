"""Quality rules and the divergence of sources, against plain versions."""

import random

import brute
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelfwise.llm import source_divergence as divergence
from shelfwise.llm.quality_rules import BASE_RULES, RULES, estimated, judged_documents, keep_documents, rule_report
from shelfwise.llm.source_divergence import divergence_audit, run_sum, shares
from shelfwise.llm.staging import forget
from shelfwise.llm.word_arrays import LetterPiece, WordPiece

FIELDS = ["lang", "source", "part", "item", "value", "rank"]


def rule_rows(prose, odd_rows):
    rng = random.Random(4)
    clean = prose(60)
    rows = odd_rows + [(20, clean), (21, clean.upper()), (22, clean.replace(" ", "!! ")), (23, clean.replace(" ", " | "))]
    rows += [(24, clean.replace(" ", "...\n")), (25, "…\n".join([clean] * 3)), (26, "same line here\n" * 12 + clean)]
    rows += [(27, " ".join(f"{k}" for k in range(40))), (28, "a b c d e f g h " * 30), (29, f"{clean} {clean}"), (30, f"{clean} é x y z {clean[:90]}")]
    rows += [(31, "x" * 26 + " " + " ".join("y" * 30 for _ in range(40))), (32, "名前 é ñ 2 3 4 ! - " * 4), (33, "a\vb\fc\r\nd\te " * 9), (34, " a   \x1cb " * 20)]
    return rows + [(100 + k, " ".join(f"w{rng.randrange(4)}" for _ in range(rng.randrange(60)))) for k in range(80)]


def test_judged_documents(docs, prose, odd_rows, spark):
    rows = rule_rows(prose, odd_rows)
    got = judged_documents(docs(rows).selectExpr("*", "1 as words", "2 as n_words", "true as KEPT"))
    assert got.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    want = {i: brute.quality(t) for i, t in rows}
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == want
    assert {x[-1] for x in want.values()} == {True, False}
    forget(spark)


def test_any_order_keeps_the_same(docs, prose, odd_rows):
    rows = rule_rows(prose, odd_rows)
    want = sorted(i for i, t in rows if brute.quality(t)[-1])
    table = docs([*rows, (None, prose(50)), (None, None)]).selectExpr("*", "1 as `odd.name`")
    for rules in (RULES, RULES[::-1]):
        kept = keep_documents(table, rules)
        assert kept.columns == table.columns
        assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == want
        assert kept.where("doc_id is null").count() == 1


def test_estimates(docs, prose):
    rows = [(k, "short" if k % 3 else prose(30)) for k in range(90)]
    found = estimated(docs(rows).select("doc_id", "text"), BASE_RULES, 1000)
    assert {r.name: share for r, _, share in found} == {"few words": 60 / 90, "repeated words": 0.0}
    assert [r.name for r, *_ in found] == ["few words", "repeated words"] and all(s > 0 for _, s, _ in found)
    report = rule_report(docs([]), BASE_RULES).orderBy("place").collect()
    assert [(r.rule, r.rejected) for r in report] == [("few words", 0.0), ("repeated words", 0.0)]
    assert judged_documents(docs([])).count() == 0


def source_rows(prose):
    rng = random.Random(8)
    rows = [(lang, f"s{rng.randrange(5)}", prose(rng.randrange(60), 150)) for lang in ("en", "de") for _ in range(40)]
    rows += [("en", None, "ÄÖ K über Über 名前 a1b2 x"), (None, "s1", "a b a"), (None, None, "a b"), ("", "", "a"), ("", "s9", None)]
    rows += [("solo", "one", "a b c")] * 3 + [("none", "x", "p q"), ("none", "y", None), ("en", "nothing", " 12 -- "), ("en", "s1", "über ÜBER über")]
    return rows * 2 + [("en", "hot", prose(300, 20))] * 40


def test_divergence(spark, prose):
    rows = source_rows(prose)
    table = spark.createDataFrame(rows, "lang string, source string, text string")
    got = divergence_audit(table.selectExpr("*", "1 as TERM", "2 as n"))
    assert got.columns == FIELDS
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == brute.divergence(rows)
    assert any(r[0] == "none" and r[4] == 0 for r in found) and not any(r[0] == "solo" and r[2] == "pair" for r in found)
    assert divergence_audit(table.limit(0)).count() == 0
    forget(spark)


def test_divergence_in_small_blocks_and_chunks(spark, prose, monkeypatch):
    """Blocks of a few rows, two sources a task, tables passed on early, and documents cut into parts."""
    for name, value in (("BLOCK_ROWS", 7), ("COLUMNS", 2), ("HELD", 50), ("PIECE_BYTES", 64)):
        monkeypatch.setattr(divergence, name, value)
    rows = source_rows(prose)
    table = spark.createDataFrame(rows, "lang string, source string, text string").repartition(3)
    found = [tuple(r) for r in divergence_audit(table, top=3).collect()]
    assert len(found) == len(set(found)) and set(found) == brute.divergence(rows, top=3)
    forget(spark)


def test_sources_dealt_to_tasks(spark):
    rows = [("en", f"s{k % 4}", f"a b{'c' * (k % 3)}") for k in range(60)]
    table = spark.createDataFrame(rows, "lang string, source string, text string").repartition(2)
    counts = divergence.term_counts(table)
    assert counts.count() <= 2 * 4 * 4 and counts.agg(F.sum("n")).first()[0] == 120


def test_shares_and_runs():
    rng = random.Random(2)
    for _ in range(200):
        total = rng.choice([1, 7, 10**6, 10**12, 9 * 10**15])
        counts = [rng.randrange(total) for _ in range(5)]
        assert shares(np.array(counts), total).tolist() == [1 + 10**9 * (c + 1) // total for c in counts]
    a, b = ([rng.choice([3, 5, 10**6]) for _ in range(50)] for _ in range(2))
    ends = np.cumsum([rng.randrange(1, 9) for _ in range(50)])
    runs = [[(e, v) for e, v, n in zip(ends, x, [*x[1:], None], strict=True) if v != n] for x in (a, b)]
    (ea, va), (eb, vb) = ([np.array(z) for z in zip(*r, strict=True)] for r in runs)
    assert run_sum((ea, eb), (va, vb)) == sum((p - q) ** 2 // q * w for p, q, w in zip(a, b, np.diff(ends, prepend=0).tolist(), strict=True))


def test_words_of_pieces():
    texts = ["ab", "", "cd é x", " \n", "x", "e", "f  g"]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    piece = WordPiece(data, offsets, range(len(texts)))
    assert piece.words().to_pylist() == [w for t in texts for w in t.split()] and piece.first.tolist() == [0, 1, 1, 4, 4, 5, 6, 8]
    assert b"".join(piece.spaced().to_pylist()) == "".join(w + " " for t in texts for w in t.split()).encode()
    codes, kinds = piece.codes()
    assert kinds.take(pa.array(codes)).to_pylist() == piece.words().to_pylist()
    empty = LetterPiece(np.empty(0, np.uint8), np.zeros(3, np.int64), range(2))
    assert len(empty) == 0 and empty.first.tolist() == [0, 0, 0] and empty.words().to_pylist() == []
