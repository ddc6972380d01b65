"""Additive Holt-Winters smoothing for every series at once.

Level, trend and season follow the published additive recursion. They start
from the first two seasons: the first season's mean, the mean daily change
between the two, and the first season's deviations from its mean. One set of
smoothing parameters is folded natively over each series; a grid of parameters
runs through an Arrow batch function that steps all series of a batch and all
parameter sets together, which keeps the cost per set small.

A dense series is bounded by its number of days, so one row may hold it.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.forecasting import FORECAST_COLUMNS, MULTI_STEP
from shelfwise.functions.columns import train_rows
from shelfwise.schema import SERIES_KEYS

MODEL = "holt_winters"
ALPHAS = [0.05, 0.1, 0.2, 0.4]
BETAS = [0.0, 0.01, 0.05]
GAMMAS = [0.02, 0.1, 0.3]
DEFAULT_GRID = list(product(ALPHAS, BETAS, GAMMAS))

SERIES_PER_STEP = 256
STATE_TYPE = (
    "alpha double, beta double, gamma double, level double, trend double, season array<double>, sse double"
)
FIT_COLUMNS = [
    "n_train", "train_end", "alpha", "beta", "gamma", "level", "trend", "season", "sse", "aic",
]


def training_arrays(dense: DataFrame, test_fraction: float, period: int) -> DataFrame:
    """One row per series with its training units and its held-out days, in date order."""
    days = F.sort_array(F.collect_list(F.struct("sale_date", "units")))
    n_train = train_rows(F.size("days"), test_fraction).cast("int")
    return (
        dense.groupBy(*SERIES_KEYS)
        .agg(days.alias("days"))
        .withColumn("n_train", n_train)
        .where(F.col("n_train") >= 2 * period)
        .select(
            *SERIES_KEYS,
            "n_train",
            F.element_at("days", F.col("n_train"))["sale_date"].alias("train_end"),
            F.slice("days", F.lit(1), F.col("n_train"))["units"].alias("ys"),
            F.slice("days", F.col("n_train") + 1, F.size("days")).alias("held_out"),
        )
    )


def _fold(arrays: DataFrame, alpha: float, beta: float, gamma: float, period: int) -> DataFrame:
    """Fold the recursion over each series with one parameter set."""

    def season_mean(start: int):
        total = F.aggregate(F.slice("ys", start, period), F.lit(0.0), lambda acc, y: acc + y)
        return total / F.lit(float(period))

    started = arrays.withColumns({"level0": season_mean(1), "mean1": season_mean(period + 1)})
    start = F.struct(
        F.col("level0").alias("level"),
        ((F.col("mean1") - F.col("level0")) / F.lit(float(period))).alias("trend"),
        F.transform(F.slice("ys", 1, period), lambda y: y - F.col("level0")).alias("season"),
        F.lit(0.0).alias("sse"),
    )

    def step(acc, y):
        seasonal = acc["season"][0]
        expected = acc["level"] + acc["trend"]
        error = y - expected - seasonal
        level = alpha * (y - seasonal) + (1 - alpha) * expected
        return F.struct(
            level.alias("level"),
            (beta * (level - acc["level"]) + (1 - beta) * acc["trend"]).alias("trend"),
            F.concat(
                F.slice(acc["season"], 2, period - 1),
                F.array(gamma * (y - expected) + (1 - gamma) * seasonal),
            ).alias("season"),
            (acc["sse"] + error * error).alias("sse"),
        )

    parameters = [F.lit(float(x)).alias(n) for x, n in ((alpha, "alpha"), (beta, "beta"), (gamma, "gamma"))]
    folded = started.withColumn("end", F.aggregate("ys", start, step))
    return folded.withColumn(
        "state",
        F.struct(*parameters, *[F.col(f"end.{n}").alias(n) for n in ("level", "trend", "season", "sse")]),
    ).drop("level0", "mean1", "end")


def best_state_of(grid: Sequence[tuple[float, float, float]], period: int):
    """A batch function from a series to its parameter set of least squared one-step error.

    Its helper is nested, so the whole function travels to the workers by value.
    """
    sets = np.array(sorted(grid), dtype=float)

    def run(series: list[np.ndarray]) -> pd.DataFrame:
        lengths = np.array([len(ys) for ys in series])
        padded = np.zeros((lengths.max(), len(series), 1))
        for i, ys in enumerate(series):
            padded[: len(ys), i, 0] = ys
        alpha, beta, gamma = sets.T[:, None, :]
        shape = (len(series), len(sets))
        first, second = padded[:period].mean(axis=0), padded[period : 2 * period].mean(axis=0)
        level = np.broadcast_to(first, shape)
        trend = np.broadcast_to((second - first) / period, shape)
        season = np.broadcast_to(padded[:period] - first, (period, *shape)).copy()
        sse = np.zeros(shape)
        for t in range(lengths.max()):
            y, seasonal, expected = padded[t], season[t % period], level + trend
            error = y - expected - seasonal
            new_level = alpha * (y - seasonal) + (1 - alpha) * expected
            new_trend = beta * (new_level - level) + (1 - beta) * trend
            new_seasonal = gamma * (y - expected) + (1 - gamma) * seasonal
            if t >= lengths.min():  # series that have ended keep their state
                ended = (lengths <= t)[:, None]
                new_level = np.where(ended, level, new_level)
                new_trend = np.where(ended, trend, new_trend)
                new_seasonal = np.where(ended, seasonal, new_seasonal)
                error = np.where(ended, 0.0, error)
            level, trend, season[t % period] = new_level, new_trend, new_seasonal
            sse += error * error
        best = sse.argmin(axis=1)
        rows = np.arange(len(series))
        next_days = (lengths[:, None] + np.arange(period)) % period
        return pd.DataFrame(
            {
                "alpha": sets[best, 0],
                "beta": sets[best, 1],
                "gamma": sets[best, 2],
                "level": level[rows, best],
                "trend": trend[rows, best],
                "season": [season[next_days[i], i, best[i]] for i in rows],
                "sse": sse[rows, best],
            }
        )

    @F.pandas_udf(STATE_TYPE)
    def best_state(ys: pd.Series) -> pd.DataFrame:
        # similar lengths together and few series at a time: short loops, bounded memory
        order = ys.str.len().sort_values(kind="stable").index
        chunks = [order[k : k + SERIES_PER_STEP] for k in range(0, len(order), SERIES_PER_STEP)]
        parts = [run([ys[i] for i in chunk]).set_index(chunk) for chunk in chunks]
        return pd.concat(parts).loc[ys.index]

    return best_state


def fitted_series(
    dense: DataFrame,
    grid: Sequence[tuple[float, float, float]],
    test_fraction: float = 0.2,
    period: int = 7,
) -> DataFrame:
    """The fit of each series beside its training units (``ys``) and its held-out days."""
    arrays = training_arrays(dense, test_fraction, period)
    if len(grid) == 1:
        fitted = _fold(arrays, *grid[0], period)
    else:
        fitted = arrays.withColumn("state", best_state_of(grid, period)("ys"))
    n = F.col("n_train")
    n_parameters = 3 + 2 + period
    return fitted.select("*", "state.*").withColumn(
        "aic", n * F.log(F.nullif(F.col("sse") / n, F.lit(0.0))) + F.lit(2.0 * n_parameters)
    )


def holt_winters_fit(
    dense: DataFrame,
    grid: Sequence[tuple[float, float, float]] = DEFAULT_GRID,
    test_fraction: float = 0.2,
    period: int = 7,
) -> DataFrame:
    """Per series: the best (alpha, beta, gamma) of ``grid``, the end states, error and AIC.

    ``season`` starts with the value for the day after the training part. Series
    with fewer than two seasons of training days get no row.
    """
    return fitted_series(dense, grid, test_fraction, period).select(*SERIES_KEYS, *FIT_COLUMNS)


def prediction(step, period: int):
    seasonal = F.get("season", (step - 1) % period)
    return F.greatest(F.col("level") + step * F.col("trend") + seasonal, F.lit(0.0))


def holt_winters_predict(fit: DataFrame, horizon: int, period: int = 7) -> DataFrame:
    """Predict the ``horizon`` days after the training part, never below 0."""
    step = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    return fit.withColumn("step", step).select(
        *SERIES_KEYS,
        F.lit(MODEL).alias("model"),
        F.lit(MULTI_STEP).alias("mode"),
        F.date_add("train_end", F.col("step")).alias("sale_date"),
        prediction(F.col("step"), period).alias("predicted"),
    )


def holt_winters_forecast(
    dense: DataFrame,
    grid: Sequence[tuple[float, float, float]] = DEFAULT_GRID,
    test_fraction: float = 0.2,
    period: int = 7,
) -> DataFrame:
    """Predict every test day of every series."""
    return forecast_held_out(fitted_series(dense, grid, test_fraction, period), period)


def forecast_held_out(fitted: DataFrame, period: int = 7) -> DataFrame:
    """Predictions of the held-out days of fitted series, which travel with the fit, so there is no join."""
    return (
        fitted.select(*SERIES_KEYS, "level", "trend", "season", F.posexplode("held_out").alias("pos", "day"))
        .withColumns(
            {
                "model": F.lit(MODEL),
                "mode": F.lit(MULTI_STEP),
                "sale_date": F.col("day.sale_date"),
                "actual": F.col("day.units"),
                "predicted": prediction(F.col("pos") + 1, period),
            }
        )
        .select(*FORECAST_COLUMNS)
    )
