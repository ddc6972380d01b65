import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.forecasting import FORECAST_COLUMNS
from shelfwise.forecasting import holt_winters as hw
from shelfwise.forecasting import lookback as lb
from shelfwise.forecasting import moving_average as ma
from shelfwise.operators import features as ft

WEEK = [12, 5, 7, 9, 20, 30, 15]


def seasonal(n, slope=0.1):
    return [WEEK[i % 7] + slope * i + (i * 7919 % 5) for i in range(n)]


def smooth(ys, alpha, beta, gamma, m=7):
    """The additive recursion on one series, step by step."""
    level = sum(ys[:m]) / m
    trend = (sum(ys[m : 2 * m]) / m - level) / m
    season = [y - level for y in ys[:m]]
    sse = 0.0
    for y in ys:
        oldest = season.pop(0)
        expected = level + trend
        sse += (y - expected - oldest) ** 2
        following = alpha * (y - oldest) + (1 - alpha) * expected
        season.append(gamma * (y - expected) + (1 - gamma) * oldest)
        trend = beta * (following - level) + (1 - beta) * trend
        level = following
    return level, trend, season, sse


def test_moving_average_is_the_mean_of_the_last_training_days(series):
    data = {"a": list(range(20)), "b": [1, 2, 3], "c": [4]}
    out = ma.moving_average_forecast(series(data)).orderBy("product", "sale_date")
    assert out.columns == FORECAST_COLUMNS
    rows = out.collect()
    a = [r for r in rows if r["product"] == "a"]
    assert len(a) == 4 and all(r.predicted == sum(range(9, 16)) / 7 for r in a)
    assert [r.actual for r in a] == [16, 17, 18, 19]
    assert [(r.predicted, r.actual) for r in rows if r["product"] == "b"] == [(1.5, 3.0)]
    assert [r.predicted for r in rows if r["product"] == "c"] == [None]


def test_moving_average_horizon_continues_after_training(series):
    fit = ma.moving_average_fit(series({"a": list(range(20))}), window=3)
    out = ma.moving_average_predict(fit, 5).orderBy("sale_date").collect()
    assert [r.sale_date for r in out] == [dt.date(2022, 1, 17) + dt.timedelta(days=i) for i in range(5)]
    assert {r.predicted for r in out} == {14.0}


@pytest.mark.parametrize("parameters", [(0.1, 0.01, 0.1), (0.4, 0.05, 0.3), (0.9, 0.5, 0.9)])
def test_fixed_smoothing_equals_the_recursion(series, parameters):
    data = {"a": seasonal(100), "b": seasonal(63, 0.4)}
    fits = {r["product"]: r for r in hw.holt_winters_fit(series(data), [parameters]).collect()}
    for name, values in data.items():
        train = values[: int(len(values) * 0.8)]
        level, trend, season, sse = smooth(train, *parameters)
        row = fits[name]
        assert row.n_train == len(train)
        np.testing.assert_allclose([row.level, row.trend, row.sse, *row.season], [level, trend, sse, *season])
        assert row.aic == pytest.approx(len(train) * math.log(sse / len(train)) + 2 * 12)


def test_grid_equals_the_best_single_fit(series):
    data = {name: seasonal(n, slope) for name, n, slope in (("a", 100, 0.1), ("b", 37, 1.0), ("c", 260, 0.0), ("d", 100, -0.05))}
    best = {}
    for name, values in data.items():
        train = values[: int(len(values) * 0.8)]
        best[name] = min(((smooth(train, *p)[3], p) for p in hw.DEFAULT_GRID))
    for row in hw.holt_winters_fit(series(data).coalesce(1)).collect():
        sse, parameters = best[row["product"]]
        assert (row.alpha, row.beta, row.gamma) == parameters
        level, trend, season, _ = smooth(data[row["product"]][: row.n_train], *parameters)
        np.testing.assert_allclose([row.sse, row.level, row.trend, *row.season], [sse, level, trend, *season])


def test_forecast_equals_fit_and_predict(series):
    df = series({"a": seasonal(100), "b": seasonal(80, 0.3)})
    forecast = hw.holt_winters_forecast(df).orderBy("product", "sale_date").collect()
    ahead = hw.holt_winters_predict(hw.holt_winters_fit(df), 20).orderBy("product", "sale_date").collect()
    known = {(r["product"], r.sale_date): r.predicted for r in ahead}
    assert len(forecast) == 36
    assert all(known[r["product"], r.sale_date] == r.predicted for r in forecast)


def test_forecast_follows_the_season(series):
    exact = [float(WEEK[i % 7]) for i in range(140)]
    out = hw.holt_winters_forecast(series({"a": exact})).collect()
    assert max(abs(r.predicted - r.actual) for r in out) < 1e-9


def test_forecast_is_never_negative(series):
    falling = [max(0.0, 100 - 2.3 * i) for i in range(50)]
    out = hw.holt_winters_predict(hw.holt_winters_fit(series({"a": falling}), [(0.9, 0.5, 0.1)]), 60)
    assert out.where("predicted < 0").count() == 0 and out.where("predicted = 0").count() > 0


@pytest.mark.parametrize("grid", [[(0.1, 0.01, 0.1)], hw.DEFAULT_GRID])
def test_two_seasons_of_training_are_needed(series, grid):
    data = {f"n{n}": seasonal(n) for n in (10, 13, 14, 17, 18, 31)}
    fit = hw.holt_winters_fit(series(data), grid)
    assert sorted(r["product"] for r in fit.collect()) == ["n18", "n31"]


def test_constant_series_has_no_error_and_no_aic(series):
    row = hw.holt_winters_fit(series({"a": [5.0] * 40})).collect()[0]
    assert row.sse == 0.0 and row.aic is None and row.level == 5.0


def scaled_series(series, data):
    return ft.min_max_scaled(ft.temporal_split(series(data)))


def test_recursive_forecast_feeds_predictions_back(series):
    data = seasonal(60)
    windows = lb.last_windows(scaled_series(series, {"a": data}), 5)
    weights = [0.1, 0.0, 0.2, 0.3, 0.35]
    out = lb.recursive_forecast(windows, weights, 0.02, 12).orderBy("sale_date").collect()
    low, high = min(data[:48]), max(data[:48])
    values = [(x - low) / (high - low) for x in data[:48]]
    for _ in range(12):
        values.append(0.02 + sum(w * v for w, v in zip(weights, values[-5:])))
    expected = [max(0.0, v * (high - low) + low) for v in values[48:]]
    np.testing.assert_allclose([r.predicted for r in out], expected)
    assert out[0].sale_date == dt.date(2022, 1, 1) + dt.timedelta(days=48)


def test_windows_need_a_full_lookback(series):
    windows = lb.last_windows(scaled_series(series, {"short": seasonal(30), "long": seasonal(50)}), 30)
    assert [r["product"] for r in windows.collect()] == ["long"]


def test_lookback_model_learns_a_season_and_round_trips(spark, series, tmp_path):
    df = scaled_series(series, {"a": [WEEK[i % 7] for i in range(150)], "b": [WEEK[(i + 2) % 7] * 3 for i in range(120)]})
    sequences = ft.lookback_sequences(df, 14)
    checked = ft.validation_split(sequences)
    model = lb.lookback_fit(checked)
    out = lb.lookback_forecast(model, sequences)
    assert out.columns == FORECAST_COLUMNS and out.count() == 30 + 24
    assert out.agg(F.max(F.abs(F.col("actual") - F.col("predicted")))).collect()[0][0] < 0.5

    history = lb.fit_history(spark, model).orderBy("iteration").collect()
    assert history[0].objective > history[-1].objective
    losses = {r.role: r.loss for r in lb.validation_loss(model, checked).collect()}
    assert set(losses) == {"fit", "validation"} and max(losses.values()) < 0.01

    state = lb.LookbackState(model, lb.last_windows(df, 14))
    state.save(str(tmp_path / "state"))
    again = lb.LookbackState.load(spark, str(tmp_path / "state"))
    order = ["product", "sale_date"]
    ahead = state.forecast(9).orderBy(*order).collect()
    assert again.forecast(9).orderBy(*order).collect() == ahead and len(ahead) == 18
    first = {(r["product"], r.sale_date): r.predicted for r in out.collect()}
    for row in ahead:
        if row["product"] == "a" and row.sale_date == dt.date(2022, 5, 1):
            assert row.predicted == pytest.approx(first["a", row.sale_date])


def test_a_whole_series_can_be_fitted_to_look_past_its_end(series):
    data = seasonal(50)
    df = series({"a": data})
    last = dt.date(2022, 1, 1) + dt.timedelta(days=49)
    averages = ma.moving_average_predict(ma.moving_average_fit(df, test_fraction=0.0), 3)
    assert [r.predicted for r in averages.collect()] == [pytest.approx(sum(data[-7:]) / 7)] * 3
    for grid in ([(0.1, 0.01, 0.1)], hw.DEFAULT_GRID):
        fit = hw.holt_winters_fit(df, grid, test_fraction=0.0)
        ahead = hw.holt_winters_predict(fit, 3).orderBy("sale_date").collect()
        assert fit.collect()[0].n_train == 50
        assert [r.sale_date for r in ahead] == [last + dt.timedelta(days=i) for i in (1, 2, 3)]
    assert hw.holt_winters_forecast(df, test_fraction=0.0).count() == 0


def test_one_set_is_fitted_alike_by_the_fold_and_by_the_search(series):
    """A single parameter set is folded without Python; a grid of it alone, given twice, goes through the search."""
    df = series({"P": [12.0 + 3 * (i % 7) + i * 7919 % 5 for i in range(90)], "Q": [float(i % 9) for i in range(40)]})
    one, two = ({r["product"]: r for r in hw.holt_winters_fit(df, [(0.2, 0.05, 0.1)] * n).collect()} for n in (1, 2))
    for product, fit in one.items():
        for name in ("alpha", "level", "trend", "sse", "aic"):
            assert fit[name] == pytest.approx(two[product][name])
        assert fit.season == pytest.approx(two[product].season)
