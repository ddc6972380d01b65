import pytest
from pyspark.sql import functions as F

from shelfwise.forecasting import moving_average as ma
from shelfwise.forecasting import trees
from shelfwise.operators import features as ft
from shelfwise.operators.evaluation import forecast_errors

WEEK = [12, 5, 7, 9, 20, 30, 15]


@pytest.fixture(scope="module")
def rows(spark):
    import datetime as dt

    start = dt.date(2022, 1, 1)
    data = [
        ("S", p, start + dt.timedelta(days=i), float(WEEK[i % 7] * k + (i * 7919 % 3)))
        for k, p in enumerate("ab", 1)
        for i in range(200)
    ]
    from shelfwise.functions.columns import day_rows

    df = spark.createDataFrame(data, "store string, product string, sale_date date, units double")
    holidays = day_rows(spark, ft.HOLIDAYS_2022_2023, "holiday")
    split = ft.temporal_split(ft.feature_matrix(df, holidays)).cache()
    yield df, split
    split.unpersist()


def train(split):
    return split.where("part = 'train'")


def test_part(split):
    return split.where("part = 'test'")


test_part.__test__ = False


@pytest.fixture(scope="module")
def forest(rows):
    return trees.random_forest(train(rows[1]), num_trees=10, max_depth=6)


def test_forest_beats_the_moving_average(rows, forest):
    df, split = rows
    predicted = trees.tree_forecast(forest, test_part(split))
    both = forecast_errors(predicted.unionByName(ma.moving_average_forecast(df)))
    mae = {(r["product"], r.model): r.mae for r in both.collect()}
    for product in "ab":
        assert mae[product, "random_forest"] < mae[product, "moving_average_7d"] / 2


def test_predictions_are_finite_and_not_negative(rows, forest):
    predicted = trees.tree_forecast(forest, test_part(rows[1]))
    bad = predicted.where(F.isnan("predicted") | F.col("predicted").isNull() | (F.col("predicted") < 0))
    assert predicted.count() == test_part(rows[1]).count() and bad.count() == 0


def test_the_seed_fixes_the_forest(rows, forest):
    again = trees.random_forest(train(rows[1]), num_trees=10, max_depth=6)
    order = ["product", "sale_date"]
    first = trees.tree_forecast(forest, test_part(rows[1])).orderBy(*order).collect()
    assert trees.tree_forecast(again, test_part(rows[1])).orderBy(*order).collect() == first


def test_importances_sum_to_one_and_are_sorted(spark, forest):
    out = trees.feature_importance(spark, forest).collect()
    weights = [r.importance for r in out]
    assert {r.feature for r in out} == set(ft.FEATURES)
    assert sum(weights) == pytest.approx(1.0) and weights == sorted(weights, reverse=True)
    assert [tuple(r) for r in trees.feature_importance(spark, forest, top=5).collect()] == [tuple(r) for r in out[:5]]


def test_model_round_trip(rows, forest, tmp_path):
    loaded = trees.load_model(trees.save_model(forest, str(tmp_path / "forest")))
    order = ["product", "sale_date"]
    expected = trees.tree_forecast(forest, test_part(rows[1])).orderBy(*order).collect()
    assert trees.tree_forecast(loaded, test_part(rows[1])).orderBy(*order).collect() == expected


def test_boosting_improves_with_stages(rows):
    _, split = rows
    errors = []
    for stages in (1, 10):
        model = trees.gradient_boosting(train(split), stages=stages, learning_rate=0.3)
        predicted = trees.tree_forecast(model, test_part(split), trees.GRADIENT_BOOSTING)
        errors.append(predicted.agg(F.avg(F.abs(F.col("actual") - F.col("predicted")))).collect()[0][0])
    assert errors[1] < errors[0]


def test_forest_works_on_some_features_only(rows):
    names = ["dow", "lag_7", "rolling_mean_7"]
    model = trees.random_forest(train(rows[1]), names, num_trees=3, max_depth=4)
    assert trees.tree_forecast(model, test_part(rows[1]).select("store", "product", "sale_date", "units", *names)).count() > 0
