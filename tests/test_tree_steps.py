"""Days ahead by a forest, against a loop that predicts a day at a time with the fitted pipeline."""

import datetime as dt

import numpy as np
import pytest

from shelfwise.forecasting import trees
from shelfwise.forecasting.tree_steps import REACH, forest_arrays, tree_multi_step
from shelfwise.functions.columns import day_rows
from shelfwise.operators import features as ft

WEEK = [12, 5, 7, 9, 20, 30, 15]
START = dt.date(2022, 1, 1)


@pytest.fixture(scope="module")
def fitted(spark):
    sizes = {"a": 160, "b": 120, "tiny": 45}
    data = [
        ("S", p, START + dt.timedelta(days=i), float(WEEK[i % 7] * (k + 1) + i * 7919 % 5))
        for k, (p, n) in enumerate(sizes.items())
        for i in range(n)
    ]
    dense = spark.createDataFrame(data, "store string, product string, sale_date date, units double")
    holidays = day_rows(spark, ft.HOLIDAYS_2022_2023, "holiday")
    split = ft.temporal_split(ft.feature_matrix(dense, holidays)).cache()
    yield dense, holidays, split, trees.random_forest(split.where("part = 'train'"), num_trees=7, max_depth=6)
    split.unpersist()


def test_arrays_predict_as_the_pipeline_does(spark, fitted):
    *_, split, model = fitted
    want = trees.tree_forecast(model, split).orderBy("product", "sale_date").collect()
    rows = split.orderBy("product", "sale_date").select(*ft.FEATURES).toPandas().to_numpy(float)
    assert forest_arrays(spark, model).predict(rows) == pytest.approx([r.predicted for r in want])


def test_boosted_trees_predict_as_the_pipeline_does(spark, fitted):
    *_, split, _ = fitted
    model = trees.gradient_boosting(split.where("part = 'train'"), stages=4, max_depth=3)
    want = [r.prediction for r in model.transform(split).orderBy("product", "sale_date").collect()]
    rows = split.orderBy("product", "sale_date").select(*ft.FEATURES).toPandas().to_numpy(float)
    assert forest_arrays(spark, model).predict(rows) == pytest.approx(want)


def test_steps_equal_a_loop_over_days(spark, fitted):
    dense, holidays, split, model = fitted
    got = {(r["product"], r.sale_date): (r.actual, r.predicted, r["mode"]) for r in tree_multi_step(model, split).collect()}
    tests = {(r["product"], r.sale_date): r.units for r in split.where("part = 'test'").collect()}
    assert {p for p, _ in got} == {"a", "b"}  # the tiny series has fewer than REACH training rows
    assert got.keys() == {k for k in tests if k[0] != "tiny"} and all(got[k][0] == tests[k] and got[k][2] == "multi_step" for k in got)
    values = {(r["product"], r.sale_date): r.units for r in dense.collect()}
    for product in "ab":
        days = sorted(d for p, d in got if p == product)[:12]
        for day in days:
            known = [("S", p, d, values[p, d]) for p, d in values if p == product and d <= day]
            table = spark.createDataFrame(known, dense.schema)
            row = ft.feature_matrix(table, holidays).where(f"sale_date = '{day}'")
            predicted = trees.tree_forecast(model, row).first().predicted
            assert got[product, day][1] == pytest.approx(predicted)
            values[product, day] = predicted


def test_units_of_test_days_are_not_seen(spark, fitted):
    _, _, split, model = fitted
    from pyspark.sql import functions as F

    hidden = split.withColumn("units", F.when(F.col("part") == "test", 1e6).otherwise(F.col("units")))
    keys = ["product", "sale_date", "predicted"]
    assert sorted(tree_multi_step(model, hidden).select(*keys).collect()) == sorted(tree_multi_step(model, split).select(*keys).collect())


def test_too_many_nodes_are_refused(spark, fitted, monkeypatch):
    from shelfwise.forecasting import tree_steps

    monkeypatch.setattr(tree_steps, "MOST_NODES", 3)
    with pytest.raises(ValueError):
        forest_arrays(spark, fitted[-1])
    assert REACH == 30 and np.isfinite(REACH)
