"""Optimised smoothing: derivatives, never worse than the grid, batches of unequal series."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.forecasting import optimised_smoothing as opt
from shelfwise.forecasting.holt_winters import holt_winters_fit, holt_winters_predict
from shelfwise.forecasting.smoothing_search import end_states, first_states, logistic, padded, pass_over, searched

PERIOD = 7
WEEK = [12, 5, 7, 9, 20, 30, 15]


def simulated(n, rng, alpha=0.3, beta=0.05, gamma=0.2, noise=1.0):
    """A series that the recursion itself made, with errors of a known size."""
    level, trend, season, ys = 50.0, 0.2, [x - 14.0 for x in WEEK], []
    for t in range(n):
        error = rng.normal(0, noise)
        ys.append(level + trend + season[t % 7] + error)
        moved = alpha * error
        season[t % 7] += gamma * error
        level, trend = level + trend + moved, trend + beta * moved
    return np.array(ys)


def plain_sse(ys, rates, states):
    """The recursion written out."""
    (alpha, beta, gamma), level, trend, season, sse = rates, states[0], states[1], list(states[2:]), 0.0
    for t, y in enumerate(ys):
        error = y - level - trend - season[t % 7]
        new = alpha * (y - season[t % 7]) + (1 - alpha) * (level + trend)
        season[t % 7] = gamma * (y - level - trend) + (1 - gamma) * season[t % 7]
        trend = beta * (new - level) + (1 - beta) * trend
        level, sse = new, sse + error * error
    return sse


@pytest.fixture(scope="module")
def batch():
    rng = np.random.default_rng(3)
    return [simulated(n, rng) for n in (90, 200, 14, 151)] + [np.full(60, 3.0), np.arange(40.0)]


def test_derivatives_match_differences(batch):
    values, lengths = padded(batch)
    theta = np.column_stack([np.full((len(batch), 3), [-1.0, -2.0, -1.5]), first_states(values, PERIOD) + 0.3])
    found = pass_over(theta, values, lengths, PERIOD)
    assert found.sse == pytest.approx([plain_sse(ys, logistic(t[:3]), t[3:]) for ys, t in zip(batch, theta)])
    for k in range(theta.shape[1]):
        step = np.zeros_like(theta)
        step[:, k] = 1e-5
        up, down = (pass_over(theta + s, values, lengths, PERIOD).sse for s in (step, -step))
        assert -2 * found.gradient[:, k] == pytest.approx((up - down) / 2e-5, rel=1e-4, abs=1e-3)


def test_series_of_a_batch_do_not_touch_each_other(batch):
    values, lengths = padded(batch)
    theta = np.column_stack([np.full((len(batch), 3), -1.0), first_states(values, PERIOD)])
    together, _ = searched(theta, values, lengths, PERIOD, 8)
    for k, ys in enumerate(batch):
        alone, _ = searched(theta[k : k + 1], *padded([ys]), PERIOD, 8)
        assert together[k] == pytest.approx(alone[0], rel=1e-6, abs=1e-6)


def test_end_states_follow_the_recursion(batch):
    values, lengths = padded(batch)
    states = first_states(values, PERIOD)
    *_, sse = end_states(np.full((len(batch), 3), 0.2), states, values, lengths, PERIOD)
    assert sse == pytest.approx([plain_sse(ys, [0.2] * 3, s) for ys, s in zip(batch, states)])


def test_known_smoothing_is_found_and_never_worse(spark, series):
    rng = np.random.default_rng(8)
    made = {f"p{k}": simulated(700, rng).tolist() for k in range(4)} | {"flat": [5.0] * 60, "short": [1.0] * 13, "two": WEEK * 2 + WEEK}
    df = series(made)
    fits = {r["product"]: r for r in opt.optimised_fit(df).collect()}
    assert set(fits) == set(made) - {"short"}
    for k in range(4):
        fit = fits[f"p{k}"]
        truth = plain_sse(made[f"p{k}"][:560], (0.3, 0.05, 0.2), [50.0, 0.2, *[x - 14.0 for x in WEEK]])
        assert fit.sse <= truth and abs(fit.alpha - 0.3) < 0.15 and abs(fit.gamma - 0.2) < 0.15
    assert all(r.sse <= r.grid_sse * (1 + 1e-9) for r in fits.values())
    assert fits["flat"].sse == 0.0 and fits["flat"].aic is None
    assert {(r.no_worse, r.confirmed) for r in opt.checked_fit(df).collect()} == {(True, True)}
    grid = {r["product"]: r.sse for r in holt_winters_fit(df).collect()}
    assert {p: r.grid_sse for p, r in fits.items()} == pytest.approx(grid)


def test_forecast_continues_the_fit(series):
    df = series({"P": [10.0 + x for x in WEEK] * 20})
    out = opt.optimised_forecast(df).orderBy("sale_date").collect()
    assert len(out) == 28 and [r.predicted for r in out] == pytest.approx([r.actual for r in out], abs=1e-3)
    ahead = holt_winters_predict(opt.optimised_fit(df), 5).orderBy("sale_date").collect()
    assert [(r.sale_date, r.predicted) for r in ahead] == [(r.sale_date, pytest.approx(r.predicted)) for r in out[:5]]


def test_one_shuffle_for_fit_and_forecast(series):
    plan = opt.optimised_forecast(series({"P": WEEK * 5})).where(F.col("predicted") >= 0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
