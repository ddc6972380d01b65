"""Quality, toxicity, licenses and top-k search: plain versions, SQL, held-out accuracy."""

import itertools
import math
import random
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest

from shelfwise.llm.license_scan import scan_licenses
from shelfwise.llm.quality_crf import marginals, quality_scores
from shelfwise.llm.queries import ORACLE, QUERIES
from shelfwise.llm.topk_search import Best, Tree, products, top_inner_products
from shelfwise.llm.toxicity import Landmarks, subsequences, toxicity_scores

MIDDLE = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, small, name):
    got = QUERIES[name](spark, small).toPandas()
    db = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        db.execute(f"create view {table} as select * from '{small}/{table}.parquet'")
    want = db.execute(ORACLE[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    got, want = (df[columns].sort_values(columns).reset_index(drop=True) for df in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_chain_marginals_equal_enumeration():
    evidence, change = [0.3, -1.0, 0.7, 0.2, -2.0], np.array([[0.4, -0.2], [-0.5, 0.9]])
    total, good, pairs = 0.0, np.zeros(5), np.zeros((2, 2))
    for labels in itertools.product((0, 1), repeat=5):
        weight = math.exp(sum(e for e, y in zip(evidence, labels) if y) + sum(change[a, b] for a, b in zip(labels, labels[1:])))
        total += weight
        good += weight * np.array(labels)
        for a, b in zip(labels, labels[1:]):
            pairs[a, b] += weight
    found, expected, log_sum = marginals(evidence, change)
    assert np.allclose(found, good / total) and np.allclose(expected, pairs / total) and log_sum == pytest.approx(math.log(total))


def test_string_kernel_equals_enumeration():
    def weights(word):
        found = {}
        for a, b, c in itertools.combinations(range(len(word)), 3):
            if c - a < 6:
                key = word[a] + word[b] + word[c]
                found[key] = found.get(key, 0) + 0.9 ** (c - a + 1)
        return found

    mark, words = weights("^scoundrel"), ["scoundrel", "scxoundrel", "scun", "other"]
    own = sum(v * v for v in mark.values())
    want = [min(1, sum(v * mark.get(k, 0) for k, v in weights("^" + w).items()) / own) ** 2 for w in words]
    found = Landmarks(["^scoundrel"]).similarity(words)[:, 0]
    assert found == pytest.approx(want, abs=1e-5) and found[0] > found[1] > found[2]
    assert len(subsequences(["ab"])[0]) == 0


@pytest.mark.parametrize(("query", "label", "modulus", "fold", "least"), [("op2_quality_crf", "quality", 4, 2, 0.95), ("op10_toxicity", "toxic", 3, 1, 0.85)])
def test_held_out_accuracy(spark, query, label, modulus, fold, least):
    got = QUERIES[query](spark, MIDDLE).toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % modulus == fold for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.7)).all()
    labels = pd.read_parquet(f"{MIDDLE}/labels.parquet").set_index("doc_id")[label]
    known = got[got.held_out].join(labels, on="doc_id").dropna()
    assert (known.predicted == known[label]).mean() >= least


@pytest.fixture
def insulted(prose):
    """Toxic and clean rows with their labels."""
    rng, rows, labels = random.Random(2), [], []
    for k in range(240):
        text, toxic = prose(30, 400), k % 3 == 0
        if toxic:
            text += " " + rng.choice(["scoundrel", "blockhead", "nincompoop"]) + ". " + prose(10, 400)
        rows.append((k, text))
        labels.append((k, 1, int(toxic)))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_toxicity_of_changed_insults(docs, insulted, spark, prose, odd_rows):
    rows, labels = insulted
    more = {1000: "scoundrel", 1001: "s c o u n d r e l", 1002: "sc-oun-drel!", 1003: "scounxdrel", 1004: "bl0ckhead", 1005: "nincompoops"}
    rows = rows + [(i, f"{prose(20, 400)} {word} {prose(9, 400)}") for i, word in more.items()] + [(2000 + i, t) for i, t in odd_rows]
    out = {r.doc_id: r for r in toxicity_scores(docs(rows), spark.createDataFrame(labels, LABELS)).collect()}
    assert all(out[i].predicted for i in more if i != 1003)
    assert out[1003].score > 0.5 > 0.1 > max(out[i].score for i, _, toxic in labels if not toxic)
    assert not any(out[2000 + i].predicted for i, _ in odd_rows)
    assert sum(out[i].predicted == toxic for i, _, toxic in labels) >= 236


def test_scores_without_labels_or_rows(docs, spark, odd_rows):
    none = spark.createDataFrame([], LABELS)
    odd = spark.createDataFrame([(None, 1, 1), (0, None, None), (1, 7, 7), (1, 1, 1)], LABELS)
    for labels in (none, odd):
        assert {r.score for r in toxicity_scores(docs(odd_rows), labels).collect()} == {0.0}
        assert {r.score for r in quality_scores(docs(odd_rows), labels).collect()} == {0.5}
    for score in (toxicity_scores, quality_scores):
        assert score(docs([]), none).count() == 0


def test_quality_of_odd_rows(docs, spark, odd_rows, prose):
    rows = [*odd_rows, (None, prose(20))]
    for k in range(200):
        text = "\n".join(prose(12).capitalize() + "." for _ in range(4))
        rows.append((100 + k, text.upper().replace(" ", "!! ") if k % 4 == 0 else text))
    labels = spark.createDataFrame([(100 + k, int(k % 4 != 0), 0) for k in range(200)], LABELS)
    out = quality_scores(docs(rows), labels).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert sum(r.predicted == int(r.doc_id % 4 != 0) for r in out if (r.doc_id or 0) >= 100) >= 196


def test_licenses(docs, spark, odd_rows):
    rows = [
        *odd_rows,
        (20, "CC-BY. Licensed under CC BY-NC 4.0, all rights\nreserved; All Rights Reserved"),
        (21, "Licensed under the famous Apache License, Version 2.0."),
        (22, "the general public licenses"),
        (23, "cc"),
        (20, "CC-BY. Licensed under CC BY-NC 4.0, all rights\nreserved; All Rights Reserved"),
        (None, "general public license general public license"),
    ]
    out = scan_licenses(docs(rows).selectExpr("*", "1 as label", "2 as place"))
    assert out.count() == len(rows)
    got = {r.doc_id: r for r in out.collect()}
    assert (got[20].n_words, got[20].n_base, got[20].first_word, got[20].last_word) == (15, 4, 0, 12)
    assert got[20].base_labels == "cc-by,reserved" and got[20].labels == "cc-by,cc-by-nc-4.0,reserved" and got[20].score == 1
    assert got[21].labels == "apache-2.0" and got[21].n_base == 0 and 0.8 <= got[21].score < 1
    assert (got[22].labels, got[22].score, got[22].first_word) == ("", 0.0, None)
    assert (got[None].n_base, got[None].first_word, got[None].last_word) == (2, 0, 3)
    assert got[0].n_words == 0 and got[8].n_words == 10  # a no-break space is part of a word
    assert scan_licenses(docs([])).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def plain_top(rows, queries, k=5):
    sound = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, qv in [r for r in sound if r[0] in queries]:
        scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in sound if i != q and len(v) == len(qv))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_top_products(spark):
    rng = np.random.default_rng(4)
    data = np.float32(rng.normal(size=(1200, 12)) / 4)
    data[300:700] = data[300]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(data)]
    rows += [(2000, None, 0), (2001, [1.0, None] * 6, 0), (2002, [float("nan")] * 12, 0), (2003, [float("inf")] * 12, 0), (2004, [], 0), (2050, [0.5, 0.25], 0), (2051, [0.5, 0.25], 0), (None, [0.1] * 12, 0)]
    table = vectors(spark, rows)
    asked = table.where("vec_id % 50 = 0")
    got = sorted(tuple(r) for r in top_inner_products(table, asked).collect())
    assert got == plain_top(rows, {i for i, *_ in rows if i is not None and i % 50 == 0})
    assert top_inner_products(vectors(spark, []), vectors(spark, [])).count() == 0
    assert top_inner_products(table, asked.limit(0)).count() == 0


def test_bounds_save_leaves():
    rng = np.random.default_rng(6)
    points = (rng.normal(size=(4000, 3)) * 1000).astype(np.int64)
    tree, best = Tree(np.arange(4000), points), Best(1, 5)
    tree.search(np.array([-1]), points[:1], best)
    leaves, _ = tree.bounds(points[:1], np.linalg.norm(points[:1].astype(float), axis=1), best)
    assert len(leaves) < sum(1 for n in tree.nodes if n[3] is None) / 4
    assert best.scores[0].tolist() == sorted((points @ points[0]).tolist(), reverse=True)[:5]


def test_products_beyond_64_bits_are_an_error():
    large = np.array([[2**40, 2**40]], np.int64)
    with pytest.raises(OverflowError):
        products(large, large)
    near = np.array([[2**30, -(2**30)]], np.int64)
    assert products(near, near).tolist() == [[2**61]]
