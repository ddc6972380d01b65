"""Training: every model for every series, scored and ranked in one job."""

from __future__ import annotations

import inspect
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.forecasting.holt_winters import DEFAULT_GRID, fitted_series, forecast_held_out
from shelfwise.forecasting.lookback import (
    LookbackState,
    fit_history,
    last_windows,
    lookback_fit,
    lookback_forecast,
)
from shelfwise.forecasting.moving_average import moving_average_forecast
from shelfwise.forecasting.optimised_smoothing import optimised_series
from shelfwise.forecasting.reservoir import Readout, Reservoir, fit_readout
from shelfwise.forecasting.trees import (
    RANDOM_FOREST,
    feature_importance,
    random_forest,
    save_model,
    tree_forecast,
)
from shelfwise.operators import evaluation
from shelfwise.operators.cleaning import dense_series, one_series
from shelfwise.operators.features import (
    add_calendar_features,
    add_history_features,
    available_features,
    complete_features,
    lookback_sequences,
    min_max_scaled,
    temporal_split,
    validation_split,
)
from shelfwise.plans.runs import log_run
from shelfwise.schema import ROW_KEYS, SERIES_KEYS
from shelfwise.sources.files import staged, write_table


@dataclass(frozen=True)
class Training:
    """Predictions of all models, and the fitted ones for later use."""

    split: DataFrame
    forecasts: DataFrame
    forest: PipelineModel
    lookback: LookbackState
    smoothing: DataFrame
    readout: Readout | None = None

    def comparison(self, common_dates: bool = True) -> DataFrame:
        """Errors ranked per series, on the days all models predicted unless told otherwise."""
        forecasts = evaluation.on_common_dates(self.forecasts) if common_dates else self.forecasts
        return evaluation.compare_models(evaluation.forecast_errors(forecasts))

    def series_sizes(self) -> DataFrame:
        """Training and test days of each series."""
        return self.split.groupBy(*SERIES_KEYS).agg(
            F.count_if(F.col("part") == "train").alias("train_days"),
            F.count_if(F.col("part") == "test").alias("test_days"),
        )

    def fit_figures(self) -> DataFrame:
        """What each series' run records of the fits: days, the smoothing's AIC and the iterations of the sequence models."""
        aic = self.smoothing.select(*SERIES_KEYS, F.col("aic").alias("holt_winters_aic"))
        figures = self.series_sizes().join(aic, SERIES_KEYS, "left")
        figures = figures.withColumn("lookback_iterations", F.lit(self.lookback.model.summary.totalIterations))
        rounds = len(self.readout.fit.rounds) if self.readout else None
        return figures.withColumn("reservoir_rounds", F.lit(rounds).cast("int"))

    def curves(self) -> DataFrame:
        return evaluation.forecast_curves(self.split, self.forecasts)


def train_all(
    dense: DataFrame,
    holidays: DataFrame,
    test_fraction: float = 0.2,
    own_feature_split: bool = False,
    num_trees: int = 200,
    max_depth: int = 15,
    lookback: int = 30,
    max_iter: int = 50,
    grid: Sequence[tuple[float, float, float]] = DEFAULT_GRID,
    optimised: bool = True,
    reservoir_units: int = 0,
    forest: PipelineModel | None = None,
) -> Training:
    """Fit the four models on dense series and predict all test days.

    One chain in one partitioning adds the split, the scaling and the features.
    Its result is staged by series, since every model reads some columns of it
    and all but the forest need whole series again, then without a shuffle. By
    default every model is tested on the days of the series split. ``own_feature_split``
    splits the feature rows by themselves instead, after the rows without a full
    history are gone, so the forest's test part is shorter. A ``forest`` that is given
    is not fitted again. ``optimised`` searches smoothing and starting states from the grid's best
    set on. With ``reservoir_units`` a fifth model reads out a reservoir of that many
    units, fitted in rounds that the validation rows steer.
    """
    scaled = min_max_scaled(temporal_split(dense, test_fraction))
    rows = staged(add_calendar_features(add_history_features(scaled), holidays), "training-rows", SERIES_KEYS, ["sale_date"])
    series = rows.select(*ROW_KEYS, "units")
    scaled = rows.select(*ROW_KEYS, "units", "part", "scale_min", "scale_max", "scaled")

    complete = complete_features(rows)
    if own_feature_split:
        complete = staged(temporal_split(complete.drop("part"), test_fraction), "feature-rows")
    if forest is None:
        forest = random_forest(complete.where(F.col("part") == "train"), available_features(complete), num_trees, max_depth)

    sequences = lookback_sequences(scaled, lookback)
    regressor = lookback_fit(validation_split(sequences), max_iter)

    fit_series = optimised_series if optimised else fitted_series
    smoothing = staged(fit_series(series, grid, test_fraction).drop("ys"), "smoothing")

    forecasts = [
        moving_average_forecast(series, test_fraction=test_fraction),
        forecast_held_out(smoothing),
        tree_forecast(forest, complete.where(F.col("part") == "test"), RANDOM_FOREST),
        lookback_forecast(regressor, sequences),
    ]
    readout = None
    if reservoir_units:
        readout = fit_readout(validation_split(sequences), Reservoir.made(reservoir_units), lookback, rounds=max_iter)
        forecasts.append(readout.forecast(sequences))
    stacked = forecasts[0]
    for forecast in forecasts[1:]:
        stacked = stacked.unionByName(forecast)
    state = LookbackState(regressor, last_windows(scaled, lookback))
    return Training(rows.select(*ROW_KEYS, "units", "part"), stacked, forest, state, smoothing, readout)


#: What a run records of each series beside the settings.
OWN_PARAMS = ["store", "product", "train_days", "test_days", "holt_winters_aic", "lookback_iterations", "reservoir_rounds"]


def recorded_settings(**given: object) -> dict[str, object]:
    """Every setting of ``train_all``: the given ones, and the defaults of the others."""
    parameters = inspect.signature(train_all).parameters
    defaults = {n: p.default for n, p in parameters.items() if p.default is not inspect.Parameter.empty and n != "forest"}
    return defaults | given


def run_training(
    cleaned: DataFrame,
    holidays: DataFrame,
    out: str,
    store: str | None = None,
    product: str | None = None,
    common_dates: bool = True,
    run_id: str | None = None,
    **settings,
) -> DataFrame:
    """Train, score, and write forecasts, comparison, curves, models and run records under ``out``.

    With a store and product only that series is trained; it must have rows. The run is
    recorded last, under ``run_id`` or one of its own; the same id again replaces it.
    """
    if store is not None and product is not None:
        dense = one_series(cleaned, store, product)
    else:
        dense = dense_series(cleaned)
    training = train_all(dense, holidays, **settings)

    spark = cleaned.sparkSession
    forecasts = spark.read.parquet(write_table(training.forecasts, f"{out}/forecasts"))
    training = replace(training, forecasts=forecasts)
    comparison = spark.read.parquet(
        write_table(training.comparison(common_dates), f"{out}/model_comparison")
    )
    write_table(evaluation.best_model(comparison), f"{out}/best_model")
    write_table(training.curves(), f"{out}/curves")
    write_table(feature_importance(spark, training.forest), f"{out}/feature_importance")
    write_table(fit_history(spark, training.lookback.model), f"{out}/lookback_history")
    save_model(training.forest, f"{out}/random_forest")
    training.lookback.save(f"{out}/lookback")

    if training.readout is not None:
        write_table(training.readout.fit.history(spark), f"{out}/reservoir_history")
        training.readout.save(spark, f"{out}/reservoir")

    params = recorded_settings(common_dates=common_dates, **settings)
    recorded = comparison.join(training.fit_figures(), SERIES_KEYS)
    log_run(recorded, params, f"{out}/runs", run_id, OWN_PARAMS)
    return comparison
