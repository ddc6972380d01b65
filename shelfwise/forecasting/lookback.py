"""Lookback autoregressor: the next scaled value from the last ``lookback`` ones.

A linear model with Huber loss takes the place of a recurrent network: same
inputs, same one-step and recursive use, and a fit that Spark distributes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.forecasting import FORECAST_COLUMNS, MULTI_STEP, ONE_STEP
from shelfwise.operators.features import unscale
from shelfwise.schema import SERIES_KEYS

MODEL = "lookback"


def lookback_fit(
    sequences: DataFrame, max_iter: int = 50, epsilon: float = 1.35, l2: float = 0.0
) -> LinearRegressionModel:
    """Fit on the ``fit`` rows of a validation split."""
    rows = sequences.where(F.col("role") == "fit").select(
        array_to_vector("lookback").alias("features"), F.col("target").alias("label")
    )
    return LinearRegression(loss="huber", maxIter=max_iter, epsilon=epsilon, regParam=l2).fit(rows)


def fit_history(spark: SparkSession, model: LinearRegressionModel) -> DataFrame:
    """The training objective after each iteration."""
    history = model.summary.objectiveHistory
    return spark.createDataFrame(
        [(i, float(value)) for i, value in enumerate(history)], "iteration int, objective double"
    )


def validation_loss(model: LinearRegressionModel, sequences: DataFrame, delta: float = 1.0) -> DataFrame:
    """Mean Huber loss on the ``fit`` and ``validation`` rows."""
    miss = F.abs(F.col("target") - F.col("prediction"))
    loss = F.when(miss <= delta, 0.5 * miss * miss).otherwise(delta * (miss - 0.5 * delta))
    rows = sequences.withColumn("features", array_to_vector("lookback"))
    return model.transform(rows).groupBy("role").agg(F.avg(loss).alias("loss"))


def lookback_forecast(model: LinearRegressionModel, sequences: DataFrame) -> DataFrame:
    """One-step predictions of the test days from real earlier values, never below 0."""
    rows = sequences.where(F.col("part") == "test").withColumn("features", array_to_vector("lookback"))
    in_units = unscale(F.col("prediction"), F.col("scale_min"), F.col("scale_max"))
    return (
        model.transform(rows)
        .withColumns(
            {
                "model": F.lit(MODEL),
                "mode": F.lit(ONE_STEP),
                "actual": F.col("units"),
                "predicted": F.greatest(in_units, F.lit(0.0)),
            }
        )
        .select(*FORECAST_COLUMNS)
    )


def last_windows(scaled: DataFrame, lookback: int = 30) -> DataFrame:
    """Per series: scale bounds, last training day and last ``lookback`` scaled training values."""
    days = F.sort_array(F.collect_list(F.struct("sale_date", "scaled")))
    return (
        scaled.where(F.col("part") == "train")
        .groupBy(*SERIES_KEYS, "scale_min", "scale_max")
        .agg(days.alias("days"))
        .where(F.size("days") >= lookback)
        .select(
            *SERIES_KEYS,
            "scale_min",
            "scale_max",
            F.element_at("days", -1)["sale_date"].alias("train_end"),
            F.slice("days", -lookback, lookback)["scaled"].alias("last_window"),
        )
    )


def recursive_forecast(
    windows: DataFrame, weights: Sequence[float], intercept: float, horizon: int
) -> DataFrame:
    """Predict ``horizon`` days ahead, feeding each prediction back as the newest value."""
    size = len(weights)
    coefficients = F.array(*[F.lit(float(w)) for w in weights])

    def grow(values, _):
        recent = F.slice(values, -size, size)
        products = F.zip_with(recent, coefficients, lambda value, weight: value * weight)
        following = F.aggregate(products, F.lit(float(intercept)), lambda acc, x: acc + x)
        return F.concat(values, F.array(following))

    grown = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), F.col("last_window"), grow)
    in_units = unscale(F.col("value"), F.col("scale_min"), F.col("scale_max"))
    return (
        windows.withColumn("ahead", F.slice(grown, -horizon, horizon))
        .select(*SERIES_KEYS, "scale_min", "scale_max", "train_end", F.posexplode("ahead").alias("pos", "value"))
        .select(
            *SERIES_KEYS,
            F.lit(MODEL).alias("model"),
            F.lit(MULTI_STEP).alias("mode"),
            F.date_add("train_end", F.col("pos") + 1).alias("sale_date"),
            F.greatest(in_units, F.lit(0.0)).alias("predicted"),
        )
    )


@dataclass(frozen=True)
class LookbackState:
    """What a later forecast needs: the fitted model and each series' bounds and last window."""

    model: LinearRegressionModel
    windows: DataFrame

    def forecast(self, horizon: int) -> DataFrame:
        return recursive_forecast(self.windows, self.model.coefficients.toArray(), self.model.intercept, horizon)

    def save(self, path: str) -> str:
        self.model.write().overwrite().save(f"{path}/model")
        self.windows.write.mode("overwrite").parquet(f"{path}/windows")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LookbackState:
        return cls(LinearRegressionModel.load(f"{path}/model"), spark.read.parquet(f"{path}/windows"))
