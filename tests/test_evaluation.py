import datetime as dt
import math

import pytest

from shelfwise.operators import evaluation as ev
from shelfwise.plans.runs import run_rows

SCHEMA = "store string, product string, model string, mode string, sale_date date, actual double, predicted double"


def forecasts(spark, models, product="P"):
    day = dt.date(2022, 1, 1)
    rows = [
        ("S", product, model, "multi_step", day + dt.timedelta(days=i), float(a), float(p))
        for model, pairs in models.items()
        for i, (a, p) in enumerate(pairs)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_errors(spark):
    row = ev.forecast_errors(forecasts(spark, {"m": [(10, 8), (0, 3), (4, 5)]})).collect()[0]
    assert row.mape == round((0.2 + 0.25) / 2 * 100, 2)
    assert row.mae == 2.0 and row.rmse == round(math.sqrt(14 / 3), 2) and row.days == 3


def test_mape_is_null_without_sales_and_ranks_last(spark):
    df = forecasts(spark, {"a": [(0, 1), (0, 2)]}).union(forecasts(spark, {"b": [(1, 9)]}))
    out = ev.compare_models(ev.forecast_errors(df)).orderBy("rank").collect()
    assert [(r.model, r.mape) for r in out] == [("b", 800.0), ("a", None)]
    assert out[1].mape_is_worst is None and out[0].mape_is_best is True


def test_tiny_actuals_are_left_out_of_mape_only(spark):
    row = ev.forecast_errors(forecasts(spark, {"m": [(1e-9, 1), (2, 1)]})).collect()[0]
    assert row.mape == 50.0 and row.mae == 1.0


def test_ranking_uses_rounded_mape_then_name(spark):
    df = forecasts(spark, {"z": [(100, 90.001)], "a": [(100, 90.002)], "m": [(100, 99)]})
    out = ev.compare_models(ev.forecast_errors(df)).orderBy("rank").collect()
    assert [(r["rank"], r.model, r.mape) for r in out] == [(1, "m", 1.0), (2, "a", 10.0), (3, "z", 10.0)]
    assert [r.mape_is_worst for r in out] == [False, True, True]


def test_best_model_and_target(spark):
    df = forecasts(spark, {"a": [(100, 90)], "b": [(100, 80)]}).union(forecasts(spark, {"a": [(100, 50)]}, "Q"))
    best = ev.best_model(ev.compare_models(ev.forecast_errors(df))).orderBy("product").collect()
    assert [tuple(r) for r in best] == [("S", "P", "a", 10.0, True), ("S", "Q", "a", 50.0, False)]


def test_common_dates_drop_days_some_model_did_not_predict(spark):
    df = forecasts(spark, {"a": [(1, 1)] * 5, "b": [(1, 2)] * 3}).union(forecasts(spark, {"a": [(1, 1)] * 4}, "Q"))
    out = ev.forecast_errors(ev.on_common_dates(df)).collect()
    assert {(r["product"], r.model): r.days for r in out} == {("P", "a"): 3, ("P", "b"): 3, ("Q", "a"): 4}


def test_curves_hold_actuals_and_every_model(spark, series):
    from shelfwise.forecasting.moving_average import moving_average_forecast
    from shelfwise.operators.features import temporal_split

    df = series({"P": range(10)})
    out = ev.forecast_curves(temporal_split(df), moving_average_forecast(df)).collect()
    assert sorted({(r.curve, r.part) for r in out}) == [
        ("actual", "test"), ("actual", "train"), ("moving_average_7d", "test"),
    ]
    assert len(out) == 12


def test_run_records(spark):
    errors = ev.forecast_errors(forecasts(spark, {"m": [(10, 8)]}))
    out = run_rows(errors, {"lookback": 30, "store": "S"}, run_id="r1").collect()
    assert {(r.run_id, r.run_name, r.model, r.metric, r.value) for r in out} == {
        ("r1", "S_P", "m", "mape", 20.0), ("r1", "S_P", "m", "mae", 2.0), ("r1", "S_P", "m", "rmse", 2.0),
    }
    assert out[0].params == {"lookback": "30", "store": "S"} and out[0].logged_at is not None


def test_run_records_accept_no_parameters(spark):
    errors = ev.forecast_errors(forecasts(spark, {"m": [(10, 8)]}))
    assert run_rows(errors, {}).collect()[0].params == {}


@pytest.mark.parametrize("eps, mape", [(1e-8, 100.0), (5.0, 0.0)])
def test_eps_is_a_parameter(spark, eps, mape):
    df = forecasts(spark, {"m": [(1, 3), (10, 10)]})
    assert ev.forecast_errors(df, eps).collect()[0].mape == mape


def test_predictions_join_their_actuals_by_series_and_day(spark, series):
    from shelfwise.forecasting.moving_average import moving_average_fit, moving_average_predict

    df = series({"P": range(10), "Q": range(5)})
    out = ev.with_actuals(moving_average_predict(moving_average_fit(df), 30), df).collect()
    assert {(r["product"], r.actual, r.predicted) for r in out} == {("P", 8.0, 4.0), ("P", 9.0, 4.0), ("Q", 4.0, 1.5)}


def test_exact_ties_round_half_up(spark):
    row = ev.forecast_errors(forecasts(spark, {"m": [(1, 1.125)]})).collect()[0]
    assert (row.mae, row.rmse, row.mape) == (0.13, 0.13, 12.5)
