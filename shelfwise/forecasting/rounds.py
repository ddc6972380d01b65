"""Robust least squares in rounds, steered by the loss on held-back rows.

Each round is one aggregate over all rows at the current weights: the losses of the ``fit``
and the ``validation`` rows, and the weighted normal equations of the ``fit`` rows, whose
weights follow from the residuals (Huber). The weights then move towards the equations'
solution by ``rate``. A round without a lower validation loss counts: after
``halve_after`` of them the rate is halved, after ``patience`` the rounds end. The weights of
the lowest validation loss are kept.

A task sends one row of sums, whatever it read; sums are added on the executors, so the driver
gets as many numbers as the equations have.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HISTORY_TYPE = "round int, rate double, fit_loss double, validation_loss double, kept boolean"
#: Share of the loss by which a round must lower it to count as better.
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Round:
    rate: float
    fit_loss: float
    validation_loss: float


@dataclass(frozen=True)
class RoundsFit:
    """Weights of the round with the lowest validation loss, and all rounds."""

    weights: tuple[float, ...]
    intercept: float
    rounds: tuple[Round, ...]
    best: int

    def history(self, spark: SparkSession) -> DataFrame:
        """Both losses and the rate of each round, counted from 1."""
        rows = [(k + 1, r.rate, r.fit_loss, r.validation_loss, k == self.best) for k, r in enumerate(self.rounds)]
        return spark.createDataFrame(rows, HISTORY_TYPE)


def huber(miss: np.ndarray, delta: float) -> np.ndarray:
    size = np.abs(miss)
    return np.where(size <= delta, 0.5 * size * size, delta * (size - 0.5 * delta))


class Sums:
    """Losses and normal equations of rows, one batch after the other."""

    def __init__(self, weights: np.ndarray, delta: float):
        self.weights, self.delta = weights, delta
        self.matrix, self.right = np.zeros((len(weights), len(weights))), np.zeros(len(weights))
        self.losses, self.rows = np.zeros(2), np.zeros(2)

    def add(self, features: np.ndarray, target: np.ndarray, fits: np.ndarray) -> None:
        x = np.column_stack([features, np.ones(len(features))])
        miss = target - x @ self.weights
        loss = huber(miss, self.delta)
        for k, own in enumerate((fits, ~fits)):
            self.losses[k] += loss[own].sum()
            self.rows[k] += own.sum()
        pull = self.delta / np.maximum(np.abs(miss[fits]), self.delta)
        pulled = x[fits] * pull[:, None]
        self.matrix += pulled.T @ x[fits]
        self.right += pulled.T @ target[fits]

    def flat(self) -> np.ndarray:
        return np.concatenate([self.losses, self.rows, self.right, self.matrix.ravel()])


def round_sums(rows: DataFrame, weights: np.ndarray, delta: float) -> np.ndarray:
    """The sums over all ``rows`` (features, target, role), added up by place on the executors."""
    size = len(weights)

    def of_task(batches):
        sums = Sums(weights, delta)
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy()
            fits = batch.column(2).to_numpy(zero_copy_only=False) == "fit"
            sums.add(flat.reshape(-1, size - 1), batch.column(1).to_numpy(), fits)
        yield pa.RecordBatch.from_arrays([pa.array([sums.flat()], pa.list_(pa.float64()))], ["sums"])

    parts = rows.select("features", "target", "role").mapInArrow(of_task, "sums array<double>")
    added = parts.select(F.posexplode("sums").alias("place", "value")).groupBy("place").agg(F.sum("value").alias("value"))
    found = np.zeros(4 + size + size * size)
    for place, value in added.collect():
        found[place] = value
    return found


def losses(rows: DataFrame, weights: tuple[float, ...], intercept: float, delta: float = 1.0) -> DataFrame:
    """Mean Huber loss and rows of each role, natively."""
    given = F.array(*[F.lit(float(w)) for w in weights])
    products = F.zip_with("features", given, lambda x, w: x * w)
    miss = F.abs(F.col("target") - F.aggregate(products, F.lit(float(intercept)), lambda acc, x: acc + x))
    loss = F.when(miss <= delta, 0.5 * miss * miss).otherwise(delta * (miss - 0.5 * delta))
    return rows.groupBy("role").agg(F.avg(loss).alias("loss"), F.count(F.lit(1)).alias("rows"))


def fit_in_rounds(
    rows: DataFrame,
    n_features: int,
    rounds: int = 50,
    rate: float = 0.5,
    patience: int = 10,
    halve_after: int = 5,
    least_rate: float = 1e-6,
    delta: float = 1.0,
    ridge: float = 1e-6,
    start: np.ndarray | None = None,
) -> RoundsFit:
    """Fit ``rows`` (features array, target, role ``fit`` or ``validation``), which should be a stored table.

    Weights start at 0, or at ``start`` (features, then the intercept), and every round starts
    from the last one's. Without validation rows, the loss on the ``fit`` rows steers.
    """
    weights = np.zeros(n_features + 1) if start is None else np.asarray(start, float)
    done: list[Round] = []
    kept, best, lowest, waited, stalled = weights, 0, np.inf, 0, 0
    for k in range(rounds):
        sums = round_sums(rows, weights, delta)
        if not sums[2]:
            raise ValueError("no rows to fit")
        fit_loss = sums[0] / sums[2]
        steering = sums[1] / sums[3] if sums[3] else fit_loss
        done.append(Round(rate, float(fit_loss), float(steering)))
        if steering < lowest * (1 - LEAST_GAIN):
            kept, best, lowest, waited, stalled = weights, k, steering, 0, 0
        else:
            waited, stalled = waited + 1, stalled + 1
            if stalled >= halve_after:
                rate, stalled = max(rate / 2, least_rate), 0
            if waited >= patience:
                break
        size = len(weights)
        right, matrix = sums[4 : 4 + size], sums[4 + size :].reshape(size, size)
        held = ridge * np.trace(matrix) / size
        weights = weights + rate * (np.linalg.solve(matrix + held * np.eye(size), right) - weights)
    return RoundsFit(tuple(kept[:-1].tolist()), float(kept[-1]), tuple(done), best)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
