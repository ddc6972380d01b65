"""A fixed reservoir of units over the lookback windows, and read-outs fitted in rounds.

The reservoir is a ring: each unit sees the unit before it, the window's next value and a bias,
through tanh. Its weights are made, not fitted, and it is folded natively over each
window from rest. The read-out is linear in the window and in the units' last states, so
the model is a linear autoregressor plus what the units add to it; without units it is the
autoregressor.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.forecasting import FORECAST_COLUMNS, MULTI_STEP, ONE_STEP
from shelfwise.forecasting.rounds import RoundsFit, fit_in_rounds
from shelfwise.operators.features import unscale
from shelfwise.schema import SERIES_KEYS
from shelfwise.sources.files import staged

LINEAR, RESERVOIR = "lookback_rounds", "reservoir"


@dataclass(frozen=True)
class Reservoir:
    """Ring weight, and each unit's input weight and bias; no units, no states."""

    ring: float = 0.0
    inputs: tuple[float, ...] = ()
    biases: tuple[float, ...] = ()

    @classmethod
    def made(cls, size: int = 24, ring: float = 0.8, spread: float = 1.5, seed: int = 42) -> Reservoir:
        rng = np.random.default_rng(seed)
        return cls(ring, tuple(rng.uniform(-spread, spread, size).tolist()), tuple(rng.uniform(-0.5, 0.5, size).tolist()))

    def states(self, window: Column) -> Column:
        """The units after the window's last value."""
        size = len(self.inputs)
        units = F.array(*[F.struct(F.lit(v).alias("v"), F.lit(b).alias("b")) for v, b in zip(self.inputs, self.biases, strict=True)])

        def step(state: Column, x: Column) -> Column:
            before = F.concat(F.slice(state, size, 1), F.slice(state, 1, size - 1))
            return F.zip_with(before, units, lambda h, unit: F.tanh(self.ring * h + unit["v"] * x + unit["b"]))

        return F.aggregate(window, F.array_repeat(F.lit(0.0), size), step)

    def features(self, window: Column) -> Column:
        return F.concat(window, self.states(window)) if self.inputs else window


def _dot(features: Column, weights: tuple[float, ...], intercept: float) -> Column:
    given = F.array(*[F.lit(float(w)) for w in weights])
    return F.aggregate(F.zip_with(features, given, lambda x, w: x * w), F.lit(float(intercept)), lambda acc, x: acc + x)


@dataclass(frozen=True)
class Readout:
    """A reservoir and the weights of its read-out."""

    reservoir: Reservoir
    weights: tuple[float, ...]
    intercept: float
    fit: RoundsFit | None = field(default=None, compare=False)

    @property
    def name(self) -> str:
        return RESERVOIR if self.reservoir.inputs else LINEAR

    @property
    def lookback(self) -> int:
        return len(self.weights) - len(self.reservoir.inputs)

    def forecast(self, sequences: DataFrame) -> DataFrame:
        """One-step predictions of the test days from real earlier values, never below 0."""
        scaled = _dot(self.reservoir.features(F.col("lookback")), self.weights, self.intercept)
        in_units = unscale(scaled, F.col("scale_min"), F.col("scale_max"))
        return sequences.where(F.col("part") == "test").select(
            *SERIES_KEYS,
            F.lit(self.name).alias("model"),
            F.lit(ONE_STEP).alias("mode"),
            "sale_date",
            F.col("units").alias("actual"),
            F.greatest(in_units, F.lit(0.0)).alias("predicted"),
        ).select(*FORECAST_COLUMNS)

    def ahead(self, windows: DataFrame, horizon: int) -> DataFrame:
        """Predict ``horizon`` days after the training part, feeding each prediction back."""
        size = self.lookback

        def grow(values: Column, _: Column) -> Column:
            recent = F.slice(values, -size, size)
            return F.concat(values, F.array(_dot(self.reservoir.features(recent), self.weights, self.intercept)))

        grown = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), F.col("last_window"), grow)
        in_units = unscale(F.col("value"), F.col("scale_min"), F.col("scale_max"))
        steps = windows.withColumn("ahead", F.slice(grown, -horizon, horizon))
        return steps.select(*SERIES_KEYS, "scale_min", "scale_max", "train_end", F.posexplode("ahead").alias("pos", "value")).select(
            *SERIES_KEYS,
            F.lit(self.name).alias("model"),
            F.lit(MULTI_STEP).alias("mode"),
            F.date_add("train_end", F.col("pos") + 1).alias("sale_date"),
            F.greatest(in_units, F.lit(0.0)).alias("predicted"),
        )

    def save(self, spark: SparkSession, path: str) -> str:
        row = (self.reservoir.ring, list(self.reservoir.inputs), list(self.reservoir.biases), list(self.weights), self.intercept)
        kinds = "ring double, inputs array<double>, biases array<double>, weights array<double>, intercept double"
        spark.createDataFrame([row], kinds).write.mode("overwrite").parquet(path)
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Readout:
        row = spark.read.parquet(path).first()
        return cls(Reservoir(row.ring, tuple(row.inputs), tuple(row.biases)), tuple(row.weights), row.intercept)


def with_features(sequences: DataFrame, reservoir: Reservoir) -> DataFrame:
    """(features, target, role) of sequences marked by ``validation_split``."""
    return sequences.select(reservoir.features(F.col("lookback")).alias("features"), "target", "role")


def fit_readout(sequences: DataFrame, reservoir: Reservoir, lookback: int = 30, **settings) -> Readout:
    """Fit a read-out on sequences marked by ``validation_split``; features are worked out once and staged."""
    rows = staged(with_features(sequences, reservoir), "readout-rows")
    fit = fit_in_rounds(rows, lookback + len(reservoir.inputs), **settings)
    return Readout(reservoir, fit.weights, fit.intercept, fit)
