"""Least squared one-step error of additive Holt-Winters smoothing, for many series together.

Smoothing parameters and starting states are searched by damped Gauss-Newton steps
(Levenberg-Marquardt). One pass over the days steps all series of a batch and carries, beside
level, trend and season, their derivatives by each of the 5 + period unknowns, so a pass gives
every series' error, gradient and Gauss-Newton matrix. Each series has a damping of its own;
a step that does not lower its error is taken back, so errors never rise.

Smoothing parameters are searched through the logistic function and so stay between 0 and 1.
Functions of this module travel to workers by value.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle

SERIES_AT_ONCE = 64
DAYS_AT_ONCE = 128
EDGE = 1e-4
#: A series is done when an accepted step gains less than this share of its error, or damping passes the limit.
GAIN, MOST_DAMPING = 1e-7, 1e10


@dataclass
class Pass:
    """What a pass over all days gives: errors, gradients, Gauss-Newton matrices."""

    sse: np.ndarray
    gradient: np.ndarray
    matrix: np.ndarray


def padded(series: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(days, series) values with zeros behind a series' end, and the lengths."""
    lengths = np.array([len(ys) for ys in series])
    values = np.zeros((lengths.max(initial=0), len(series)))
    for k, ys in enumerate(series):
        values[: len(ys), k] = ys
    return values, lengths


def first_states(values: np.ndarray, period: int) -> np.ndarray:
    """Level, trend and season of the first two periods: (series, 2 + period)."""
    first, second = values[:period].mean(axis=0), values[period : 2 * period].mean(axis=0)
    return np.column_stack([first, (second - first) / period, (values[:period] - first).T])


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def pass_over(theta: np.ndarray, values: np.ndarray, lengths: np.ndarray, period: int) -> Pass:
    """Errors of ``theta`` (series, 5 + period: three logits, level, trend, season) and their derivatives."""
    n, size = theta.shape
    rates = logistic(theta[:, :3])
    alpha, beta, gamma = rates.T
    slopes = np.zeros((3, n, size))
    for k in range(3):
        slopes[k, :, k] = rates[:, k] * (1 - rates[:, k])
    level, trend, season = theta[:, 3].copy(), theta[:, 4].copy(), theta[:, 5:].T.copy()
    d_level, d_trend, d_season = np.zeros((n, size)), np.zeros((n, size)), np.zeros((period, n, size))
    d_level[:, 3] = d_trend[:, 4] = 1
    for k in range(period):
        d_season[k, :, 5 + k] = 1
    a, b, g = alpha[:, None], beta[:, None], gamma[:, None]
    sse, gradient, matrix = np.zeros(n), np.zeros((n, size)), np.zeros((n, size, size))
    for start in range(0, len(values), DAYS_AT_ONCE):
        stop = min(start + DAYS_AT_ONCE, len(values))
        errors, slopes_of = np.zeros((stop - start, n)), np.zeros((stop - start, n, size))
        for t in range(start, stop):
            seasonal, d_seasonal = season[t % period], d_season[t % period]
            expected, d_expected = level + trend, d_level + d_trend
            error = values[t] - expected - seasonal
            errors[t - start], slopes_of[t - start] = error, d_expected + d_seasonal
            new_level = expected + alpha * error
            d_new = d_expected - a * slopes_of[t - start] + slopes[0] * error[:, None]
            moved = new_level - level - trend
            d_trend = d_trend + b * (d_new - d_level - d_trend) + slopes[1] * moved[:, None]
            trend = trend + beta * moved
            season[t % period] = seasonal + gamma * error
            d_season[t % period] = d_seasonal - g * slopes_of[t - start] + slopes[2] * error[:, None]
            level, d_level = new_level, d_new
        alive = (np.arange(start, stop)[:, None] < lengths).astype(float)
        errors *= alive
        slopes_of *= alive[:, :, None]
        sse += (errors * errors).sum(axis=0)
        gradient += np.einsum("tn,tnk->nk", errors, slopes_of)
        matrix += np.einsum("tnk,tnj->nkj", slopes_of, slopes_of)
    return Pass(sse, gradient, matrix)


def end_states(rates: np.ndarray, states: np.ndarray, values: np.ndarray, lengths: np.ndarray, period: int) -> tuple[np.ndarray, ...]:
    """(level, trend, season from the next day on, squared error) after each series' last day."""
    alpha, beta, gamma = rates.T
    level, trend, season = states[:, 0].copy(), states[:, 1].copy(), states[:, 2:].T.copy()
    sse = np.zeros(len(states))
    for t in range(len(values)):
        alive = t < lengths
        seasonal, expected = season[t % period], level + trend
        error = np.where(alive, values[t] - expected - seasonal, 0.0)
        new_level = np.where(alive, alpha * (values[t] - seasonal) + (1 - alpha) * expected, level)
        trend = np.where(alive, beta * (new_level - level) + (1 - beta) * trend, trend)
        season[t % period] = np.where(alive, gamma * (values[t] - expected) + (1 - gamma) * seasonal, seasonal)
        level = new_level
        sse += error * error
    order = (lengths[:, None] + np.arange(period)) % period
    return level, trend, np.take_along_axis(season.T, order, axis=1), sse


def searched(theta: np.ndarray, values: np.ndarray, lengths: np.ndarray, period: int, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """The unknowns of least error that the steps reach from ``theta``, and how many steps each series took."""
    best = pass_over(theta, values, lengths, period)
    damping = np.full(len(theta), 1e-3)
    taken = np.zeros(len(theta), int)
    moving = best.sse > 0
    for _ in range(steps):
        if not moving.any():
            break
        diagonal = np.einsum("nkk->nk", best.matrix)
        damped = best.matrix.copy()
        added = damping[:, None] * diagonal + 1e-12 * (1 + diagonal.max(axis=1, keepdims=True))
        damped[:, np.arange(theta.shape[1]), np.arange(theta.shape[1])] += added
        step = np.linalg.solve(damped, best.gradient[..., None])[..., 0]
        step[:, :3] = np.clip(step[:, :3], -2, 2)
        tried = np.where(moving[:, None], theta + step, theta)
        tried[:, :3] = np.clip(tried[:, :3], -12, 12)
        found = pass_over(tried, values, lengths, period)
        better = moving & (found.sse < best.sse)
        little = better & (best.sse - found.sse <= GAIN * best.sse)
        taken += moving
        theta = np.where(better[:, None], tried, theta)
        best.sse = np.where(better, found.sse, best.sse)
        best.gradient = np.where(better[:, None], found.gradient, best.gradient)
        best.matrix = np.where(better[:, None, None], found.matrix, best.matrix)
        damping = np.where(better, damping / 5, damping * 4)
        moving &= ~little & (damping < MOST_DAMPING)
    return theta, taken


def optimised(series: list[np.ndarray], rates: np.ndarray, grid_sse: np.ndarray, period: int, steps: int) -> dict[str, np.ndarray]:
    """Smoothing, starting and end states of each series, from the best set of a grid; never worse than that."""
    values, lengths = padded(series)
    states = first_states(values, period)
    start = np.clip(rates, EDGE, 1 - EDGE)
    theta = np.column_stack([np.log(start / (1 - start)), states])
    theta, taken = searched(theta, values, lengths, period, steps)
    found = logistic(theta[:, :3]), theta[:, 3:]
    level, trend, season, sse = end_states(*found, values, lengths, period)
    worse = ~(sse <= grid_sse)  # also where a search has left the numbers
    if worse.any():
        found = np.where(worse[:, None], rates, found[0]), np.where(worse[:, None], states, found[1])
        level, trend, season, sse = end_states(*found, values, lengths, period)
    return {
        "alpha": found[0][:, 0], "beta": found[0][:, 1], "gamma": found[0][:, 2],
        "first_level": found[1][:, 0], "first_trend": found[1][:, 1], "first_season": list(found[1][:, 2:]),
        "level": level, "trend": trend, "season": list(season), "sse": sse, "steps": taken,
    }


cloudpickle.register_pickle_by_value(sys.modules[__name__])
