"""Holt-Winters smoothing with optimised smoothing parameters and starting states.

The best set of a grid, with states of the first two periods, is where the search of
``smoothing_search`` starts; what it returns is never worse on the training days. Series are
searched where their rows are, a batch at a time; a dense series is bounded by its days.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.forecasting.holt_winters import DEFAULT_GRID, best_state_of, forecast_held_out, training_arrays
from shelfwise.forecasting.smoothing_search import SERIES_AT_ONCE, optimised
from shelfwise.schema import SERIES_KEYS

STEPS = 60
STATE_TYPE = (
    "alpha double, beta double, gamma double, first_level double, first_trend double, first_season array<double>, "
    "level double, trend double, season array<double>, sse double, steps int"
)
FIT_COLUMNS = ["n_train", "train_end", *[part.split()[0] for part in STATE_TYPE.split(", ")], "grid_sse", "aic"]


def _search(period: int, steps: int):
    """A batch function from series and the best of a grid to optimised parameters and states."""
    at_once = SERIES_AT_ONCE

    @F.pandas_udf(STATE_TYPE)
    def search(ys: pd.Series, alpha: pd.Series, beta: pd.Series, gamma: pd.Series, sse: pd.Series) -> pd.DataFrame:
        rates = np.column_stack([alpha, beta, gamma])
        order = ys.str.len().argsort(kind="stable").to_numpy()  # similar lengths together
        parts = []
        for k in range(0, len(order), at_once):
            own = order[k : k + at_once]
            found = optimised([ys.iloc[i] for i in own], rates[own], sse.to_numpy()[own], period, steps)
            parts.append(pd.DataFrame(found, index=own))
        return pd.concat(parts).sort_index()

    return search


def optimised_series(
    dense: DataFrame,
    grid: Sequence[tuple[float, float, float]] = DEFAULT_GRID,
    test_fraction: float = 0.2,
    period: int = 7,
    steps: int = STEPS,
) -> DataFrame:
    """The optimised fit of each series beside its training units (``ys``) and its held-out days."""
    arrays = training_arrays(dense, test_fraction, period).withColumn("grid", best_state_of(grid, period)("ys"))
    given = ["ys", "grid.alpha", "grid.beta", "grid.gamma", "grid.sse"]
    found = arrays.withColumn("state", _search(period, steps)(*given)).withColumn("grid_sse", F.col("grid.sse"))
    n, n_parameters = F.col("n_train"), 3 + 2 + period
    aic = n * F.log(F.nullif(F.col("sse") / n, F.lit(0.0))) + F.lit(2.0 * n_parameters)
    return found.select(*SERIES_KEYS, "n_train", "train_end", "ys", "held_out", "grid_sse", "state.*").withColumn("aic", aic)


def optimised_fit(
    dense: DataFrame,
    grid: Sequence[tuple[float, float, float]] = DEFAULT_GRID,
    test_fraction: float = 0.2,
    period: int = 7,
    steps: int = STEPS,
) -> DataFrame:
    """Per series: optimised parameters, starting and end states, steps taken, error, the grid's error and AIC.

    ``season`` starts with the value for the day after the training part, ``first_season``
    with the first day's. ``holt_winters_predict`` takes this fit as well.
    """
    return optimised_series(dense, grid, test_fraction, period, steps).select(*SERIES_KEYS, *FIT_COLUMNS)


def replayed_error(ys: Column, period: int = 7) -> Column:
    """The squared one-step error of a fit's starting states and parameters over ``ys``, natively."""
    start = F.struct(
        F.col("first_level").alias("level"), F.col("first_trend").alias("trend"), F.col("first_season").alias("season"), F.lit(0.0).alias("sse")
    )

    def step(acc, y):
        seasonal = acc["season"][0]
        expected = acc["level"] + acc["trend"]
        error = y - expected - seasonal
        level = F.col("alpha") * (y - seasonal) + (1 - F.col("alpha")) * expected
        following = F.col("gamma") * (y - expected) + (1 - F.col("gamma")) * seasonal
        return F.struct(
            level.alias("level"),
            (F.col("beta") * (level - acc["level"]) + (1 - F.col("beta")) * acc["trend"]).alias("trend"),
            F.concat(F.slice(acc["season"], 2, period - 1), F.array(following)).alias("season"),
            (acc["sse"] + error * error).alias("sse"),
        )

    return F.aggregate(ys, start, step)["sse"]


def checked_fit(dense: DataFrame, test_fraction: float = 0.2, period: int = 7) -> DataFrame:
    """Per series: the grid's error, whether the optimised one is no larger, and whether a native replay confirms it."""
    found = optimised_series(dense, DEFAULT_GRID, test_fraction, period, STEPS).withColumn("replayed", replayed_error(F.col("ys"), period))
    return found.select(
        *SERIES_KEYS,
        "n_train",
        "grid_sse",
        (F.col("replayed") <= F.col("grid_sse") * (1 + 1e-9)).alias("no_worse"),
        (F.abs(F.col("replayed") - F.col("sse")) <= 1e-6 * (F.col("sse") + 1)).alias("confirmed"),
    )


def optimised_forecast(
    dense: DataFrame,
    grid: Sequence[tuple[float, float, float]] = DEFAULT_GRID,
    test_fraction: float = 0.2,
    period: int = 7,
    steps: int = STEPS,
) -> DataFrame:
    """Predict every test day of every series, never below 0."""
    return forecast_held_out(optimised_series(dense, grid, test_fraction, period, steps), period)
