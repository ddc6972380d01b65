"""Permutation importance: values stay within their day, and what a model ignores does not count."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.forecasting import trees
from shelfwise.forecasting.permutation import exchanged, groups_of_a_day, linear_importance, model_importance

FIELDS = "store string, product string, sale_date date, units double, a double, b double, c double"


@pytest.fixture(scope="module")
def rows(spark):
    rng, out = random.Random(5), []
    for day in range(12):
        for s in "AB":
            for p in range(6):
                a, b, c = rng.random(), rng.random(), rng.random()
                out.append((s, f"p{p}", dt.date(2022, 1, 1) + dt.timedelta(days=day), 5 * a - b + 1, a, b, c))
    return spark.createDataFrame(out, FIELDS)


def plain_exchange(table, name):
    """{(day, store, product): value of the next row of the day in order of the hash}."""
    out = {}
    for day in {r.sale_date for r in table}:
        order = sorted((hashlib.md5(f"{r.store}|{r['product']}|{name}".encode()).hexdigest(), r) for r in table if r.sale_date == day)
        for k, (_, r) in enumerate(order):
            out[day, r.store, r["product"]] = order[(k + 1) % len(order)][1][name]
    return out


def test_values_change_places_within_a_day(rows):
    table = rows.collect()
    got = exchanged(rows, ["a", "c"]).collect()
    for name in ("a", "c"):
        want = plain_exchange(table, name)
        assert {(r.sale_date, r.store, r["product"]): r[f"other_{name}"] for r in got} == want


def test_linear_importance(rows):
    table = rows.collect()
    got = {r.feature: r for r in linear_importance(rows, {"a": 5.0, "b": -1.0, "c": 0.0}, 1.0).collect()}
    assert list(got) == ["a", "b", "c"] and got["c"].importance == pytest.approx(0)
    for name, weight in (("a", 5.0), ("b", -1.0)):
        other = plain_exchange(table, name)
        miss = [abs(weight * (other[r.sale_date, r.store, r["product"]] - r[name])) for r in table]
        assert got[name].mae == pytest.approx(0) and got[name].mae_exchanged == pytest.approx(sum(miss) / len(miss))


def test_any_model_gives_what_the_linear_one_gives(rows):
    def predict(df):
        return df.withColumn("prediction", 5 * F.col("a") - F.col("b") + 1)

    both = [model_importance(predict, rows, ["a", "b", "c"]), linear_importance(rows, {"a": 5.0, "b": -1.0, "c": 0.0}, 1.0)]
    first, second = ({r.feature: r.mae_exchanged for r in df.collect()} for df in both)
    assert first == pytest.approx(second)


def test_a_forest_leans_on_what_made_the_sales(rows):
    model = trees.random_forest(rows, ["a", "b", "c"], num_trees=10, max_depth=5, min_leaf=1)
    found = model_importance(model.transform, rows, ["a", "b", "c"]).collect()
    assert found[0].feature == "a" and found[0].importance > 5 * max(found[2].importance, 0)


def test_large_days_are_cut_into_groups(rows):
    assert groups_of_a_day(rows) == 1 and groups_of_a_day(rows, 5) in (2, 3)
    moved = exchanged(rows, ["a"], groups=3).collect()
    before, after = (sorted((r.sale_date, r[c]) for r in moved) for c in ("a", "other_a"))
    assert before == after


def test_one_shuffle_for_all_features(rows):
    plan = exchanged(rows, ["a", "b", "c"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
