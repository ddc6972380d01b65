"""A fitted tree ensemble as arrays, and days ahead predicted from its own predictions.

Functions and classes of this module travel to workers by value.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle

#: Series that one step predicts together; bounds the memory of a batch.
SERIES_AT_ONCE = 128


@dataclass(frozen=True)
class ForestArrays:
    """Nodes of all trees, one after the other; a leaf is its own child.

    ``shift`` and ``scale`` are what the features are standardised by before the trees see
    them; ``weights`` are the trees'.
    """

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    weights: np.ndarray
    shift: np.ndarray
    scale: np.ndarray
    depth: int

    def predict(self, rows: np.ndarray) -> np.ndarray:
        """The ensemble's prediction for each row of features."""
        x = (rows - self.shift) * self.scale
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        own = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            below = x[own, self.feature[node]] <= self.threshold[node]
            node = np.where(below, self.left[node], self.right[node])
        return (self.value[node] * self.weights).sum(axis=1)


def history_features(name: str, past: np.ndarray) -> np.ndarray:
    """A lag or rolling feature of the day after ``past`` (series, days)."""
    kind, _, size = name.rpartition("_")
    days = int(size)
    if kind == "lag":
        return past[:, -days]
    window = past[:, -days:]
    if kind == "rolling_mean":
        return window.mean(axis=1)
    return window.max(axis=1) if kind == "rolling_max" else window.std(axis=1, ddof=1)


def days_ahead(forest: ForestArrays, names: Sequence[str], known: Sequence[str], past: list[np.ndarray], calendar: list[np.ndarray]) -> list[np.ndarray]:
    """Predictions for each series' days, each from its past and the predictions so far, never below 0.

    ``calendar`` has the ``known`` features of the days, by series (days, features); the
    other names are rebuilt from the past every day, for all series of a step together.
    """
    out: list[np.ndarray] = [np.empty(0)] * len(past)
    order = np.argsort([len(c) for c in calendar], kind="stable")
    place = {name: k for k, name in enumerate(known)}
    for k in range(0, len(order), SERIES_AT_ONCE):
        own = order[k : k + SERIES_AT_ONCE]
        lengths = np.array([len(calendar[i]) for i in own])
        reach, horizon = len(past[own[0]]), int(lengths.max())
        days = np.zeros((len(own), reach + horizon))
        days[:, :reach] = [past[i] for i in own]
        ahead = np.zeros((len(own), horizon, len(known)))
        for j, i in enumerate(own):
            ahead[j, : lengths[j]] = calendar[i]
        for step in range(horizon):
            so_far = days[:, step : reach + step]
            features = [ahead[:, step, place[n]] if n in place else history_features(n, so_far) for n in names]
            days[:, reach + step] = np.maximum(forest.predict(np.column_stack(features)), 0.0)
        for j, i in enumerate(own):
            out[i] = days[j, reach : reach + lengths[j]]
    return out


cloudpickle.register_pickle_by_value(sys.modules[__name__])
