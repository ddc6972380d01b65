"""Forecast errors per series and model, and model comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.forecasting import FORECAST_COLUMNS
from shelfwise.schema import ROW_KEYS, SERIES_KEYS, series_window

# Actuals at or below the first are left out of MAPE; a model below
# the second meets the accuracy goal.
MAPE_EPS = 1e-8
MAPE_TARGET = 15.0

METRICS = ["mape", "mae", "rmse"]


def with_actuals(predictions: DataFrame, series: DataFrame) -> DataFrame:
    """Predictions of known days beside the units of the same series and day."""
    actuals = series.select(*ROW_KEYS, F.col("units").alias("actual"))
    return predictions.join(actuals, ROW_KEYS).select(*FORECAST_COLUMNS)


def on_common_dates(forecasts: DataFrame) -> DataFrame:
    """Keep the days of each series that all of its models predicted.

    Whole series are placed together first: that one shuffle serves the counts
    per day, their maximum per series, and the errors and ranks computed later.
    """
    of_day = Window.partitionBy(*SERIES_KEYS, "sale_date")
    return (
        forecasts.repartition(*SERIES_KEYS)
        .withColumn("models_on_day", F.count("model").over(of_day))
        .withColumn("models", F.max("models_on_day").over(series_window()))
        .where(F.col("models_on_day") == F.col("models"))
        .drop("models_on_day", "models")
    )


def forecast_errors(forecasts: DataFrame, eps: float = MAPE_EPS) -> DataFrame:
    """MAPE (%), MAE and RMSE per series and model, rounded to 2 decimals.

    MAPE leaves out days without sales and is null if no day is left.
    """
    miss = F.col("actual") - F.col("predicted")
    relative = F.when(F.abs("actual") > eps, F.abs(F.try_divide(miss, F.col("actual"))))
    return forecasts.groupBy(*SERIES_KEYS, "model", "mode").agg(
        F.round(F.avg(relative) * 100, 2).alias("mape"),
        F.round(F.avg(F.abs(miss)), 2).alias("mae"),
        F.round(F.sqrt(F.avg(miss * miss)), 2).alias("rmse"),
        F.count(F.lit(1)).alias("days"),
    )


def compare_models(errors: DataFrame) -> DataFrame:
    """Rank the models of each series by rounded MAPE, then name; flag extremes per metric."""
    by_mape = series_window().orderBy(F.asc_nulls_last("mape"), "model")
    flags = {}
    for metric in METRICS:
        flags[f"{metric}_is_best"] = F.col(metric) == F.min(metric).over(series_window())
        flags[f"{metric}_is_worst"] = F.col(metric) == F.max(metric).over(series_window())
    return errors.withColumn("rank", F.row_number().over(by_mape)).withColumns(flags)


def best_model(comparison: DataFrame, target: float = MAPE_TARGET) -> DataFrame:
    """The first-ranked model of each series and whether it meets the accuracy goal."""
    return comparison.where(F.col("rank") == 1).select(
        *SERIES_KEYS,
        "model",
        "mape",
        F.coalesce(F.col("mape") < target, F.lit(False)).alias("meets_target"),
    )


def forecast_curves(split: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Actual units and every model's predictions in one long table."""
    actual = split.select(
        *SERIES_KEYS, "sale_date", "part", F.lit("actual").alias("curve"), F.col("units").alias("value")
    )
    predicted = forecasts.select(
        *SERIES_KEYS,
        "sale_date",
        F.lit("test").alias("part"),
        F.col("model").alias("curve"),
        F.col("predicted").alias("value"),
    )
    return actual.unionByName(predicted)
