"""Fits steered by validation rows, and the reservoir's read-out."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.forecasting import rounds as rd
from shelfwise.forecasting.lookback import last_windows
from shelfwise.forecasting.reservoir import LINEAR, RESERVOIR, Readout, Reservoir, fit_readout, with_features
from shelfwise.operators import features as ft
from shelfwise.operators.evaluation import forecast_errors

WEEK = [12, 5, 7, 9, 20, 30, 15]


def rows_of(spark, data):
    return spark.createDataFrame(data, "features array<double>, target double, role string")


def linear_rows(rng, n, weights, noise, role, odd=0.0):
    out = []
    for _ in range(n):
        x = [rng.uniform(-1, 1) for _ in weights]
        y = sum(a * b for a, b in zip(x, weights)) + 0.5 + rng.gauss(0, noise)
        out.append((x, y + (50.0 if rng.random() < odd else 0.0), role))
    return out


def test_rounds_find_the_line_in_spite_of_outliers(spark):
    rng = random.Random(1)
    data = linear_rows(rng, 400, [2.0, -1.0, 0.0], 0.01, "fit", odd=0.05) + linear_rows(rng, 100, [2.0, -1.0, 0.0], 0.01, "validation")
    fit = rd.fit_in_rounds(rows_of(spark, data).repartition(5), 3, rounds=25, delta=0.1)
    assert fit.weights == pytest.approx((2.0, -1.0, 0.0), abs=0.02) and fit.intercept == pytest.approx(0.5, abs=0.05)
    assert fit.rounds[fit.best].validation_loss == pytest.approx(min(r.validation_loss for r in fit.rounds), rel=1e-5)


def test_history_has_both_losses_and_the_kept_round(spark):
    rng = random.Random(2)
    data = linear_rows(rng, 60, [1.0, 0.0], 0.3, "fit") + linear_rows(rng, 30, [1.0, 0.0], 0.3, "validation")
    rows = rows_of(spark, data)
    fit = rd.fit_in_rounds(rows, 2, rounds=8)
    history = fit.history(spark).orderBy("round").collect()
    assert [r.round for r in history] == list(range(1, len(fit.rounds) + 1)) and sum(r.kept for r in history) == 1
    found = {r.role: (r.loss, r["rows"]) for r in rd.losses(rows, fit.weights, fit.intercept).collect()}
    kept = next(r for r in history if r.kept)
    assert found["validation"] == (pytest.approx(kept.validation_loss), 30) and found["fit"] == (pytest.approx(kept.fit_loss), 60)


def test_patience_halving_and_the_best_weights(spark, monkeypatch):
    """Validation rows that contradict the fit: the first round is the best, and stays."""
    data = [([1.0], 1.0, "fit")] * 5 + [([1.0], 0.0, "validation")] * 5
    fit = rd.fit_in_rounds(rows_of(spark, data), 1, patience=5, halve_after=2, least_rate=0.2)
    assert fit.best == 0 and fit.weights == (0.0,) and fit.intercept == 0.0
    assert [r.rate for r in fit.rounds] == [0.5, 0.5, 0.5, 0.25, 0.25, 0.2]
    warm = rd.fit_in_rounds(rows_of(spark, data), 1, rounds=1, start=np.array([0.25, 0.25]))
    assert warm.weights == (0.25,) and warm.rounds[0].validation_loss == pytest.approx(0.125)


def test_rows_without_a_role_to_fit(spark):
    with pytest.raises(ValueError):
        rd.fit_in_rounds(rows_of(spark, [([1.0], 1.0, "validation")]), 1)
    only = rd.fit_in_rounds(rows_of(spark, [([float(k)], 2.0 * k, "fit") for k in range(9)]), 1)
    assert only.weights == pytest.approx((2.0,), abs=1e-2)


def plain_states(window, reservoir):
    state = [0.0] * len(reservoir.inputs)
    for x in window:
        before = [state[-1], *state[:-1]]
        state = [math.tanh(reservoir.ring * h + v * x + b) for h, v, b in zip(before, reservoir.inputs, reservoir.biases)]
    return state


def test_reservoir_is_folded_over_each_window(spark):
    reservoir, rng = Reservoir.made(7, seed=5), random.Random(3)
    windows = [[rng.random() for _ in range(12)] for _ in range(6)]
    df = spark.createDataFrame([(k, w) for k, w in enumerate(windows)], "k int, w array<double>")
    got = df.orderBy("k").select(reservoir.states(F.col("w")).alias("s"), reservoir.features(F.col("w")).alias("f")).collect()
    for row, window in zip(got, windows):
        assert row.s == pytest.approx(plain_states(window, reservoir), abs=1e-12) and row.f == [*window, *row.s]
    assert Reservoir.made(7, seed=5) == reservoir != Reservoir.made(7, seed=6)


@pytest.fixture(scope="module")
def bent(spark):
    """Sequences of a series whose next value bends with the last two."""
    import datetime as dt

    rng, rows = random.Random(6), []
    for p in "abc":
        x = [rng.random(), rng.random()]
        for _ in range(398):
            x.append(min(1.0, max(0.0, 0.9 * math.sin(3 * x[-1]) * (0.4 + x[-2]) + rng.gauss(0, 0.01))))
        rows += [("S", p, dt.date(2022, 1, 1) + dt.timedelta(days=k), 100 * v) for k, v in enumerate(x)]
    df = spark.createDataFrame(rows, "store string, product string, sale_date date, units double")
    scaled = ft.min_max_scaled(ft.temporal_split(df)).cache()
    yield scaled, ft.lookback_sequences(scaled, 8)
    scaled.unpersist()


def test_reservoir_beats_the_line_where_sales_bend(bent):
    scaled, sequences = bent
    marked = ft.validation_split(sequences)
    mae = {}
    for reservoir in (Reservoir(), Reservoir.made(16)):
        model = fit_readout(marked, reservoir, 8, rounds=30)
        errors = forecast_errors(model.forecast(sequences)).collect()
        mae[model.name] = sum(r.mae for r in errors) / len(errors)
        assert {r.days for r in errors} == {80}
    assert set(mae) == {LINEAR, RESERVOIR} and mae[RESERVOIR] < 0.5 * mae[LINEAR]


def test_forecasts_ahead_feed_predictions_back(bent, spark, tmp_path):
    scaled, _ = bent
    reservoir = Reservoir.made(4)
    rng = random.Random(1)
    model = Readout(reservoir, tuple(rng.uniform(-0.3, 0.3) for _ in range(8 + 4)), 0.2)
    windows = last_windows(scaled, 8)
    got = model.ahead(windows, 5).orderBy("product", "sale_date").collect()
    want = []
    for row in windows.orderBy("product").collect():
        values = list(row.last_window)
        for _ in range(5):
            recent = values[-8:]
            values.append(sum(a * b for a, b in zip(model.weights, recent + plain_states(recent, reservoir))) + model.intercept)
        want += [max(v * (row.scale_max - row.scale_min) + row.scale_min, 0.0) for v in values[-5:]]
    assert [r.predicted for r in got] == pytest.approx(want)
    assert Readout.load(spark, model.save(spark, str(tmp_path / "readout"))) == model


def test_features_are_windows_and_states(bent):
    _, sequences = bent
    row = with_features(ft.validation_split(sequences), Reservoir.made(3)).first()
    assert len(row.features) == 11 and row.role in ("fit", "validation")
