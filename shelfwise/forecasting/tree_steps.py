"""Days ahead by a tree ensemble: lags and rolling features rebuilt from its own predictions.

The fitted trees go to the workers as arrays, whose size is checked; the days of a series stay
in one row, and all series of a batch step from day to day together.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.forecasting import FORECAST_COLUMNS, MULTI_STEP
from shelfwise.forecasting.forest_arrays import ForestArrays, days_ahead
from shelfwise.forecasting.trees import RANDOM_FOREST
from shelfwise.operators.features import LAGS, ROLLING_WINDOWS
from shelfwise.schema import SERIES_KEYS
from shelfwise.sources.files import stage_path

#: What a day ahead reaches back to, and the most nodes that are sent to workers (about 32 bytes each).
REACH = max(LAGS + ROLLING_WINDOWS)
MOST_NODES = 20_000_000


def forest_arrays(spark: SparkSession, model: PipelineModel) -> ForestArrays:
    """The trees and the standardisation of a fitted pipeline, read from its stored form."""
    scaler, trees = model.stages[-2], model.stages[-1]
    n_nodes = trees.totalNumNodes
    if n_nodes > MOST_NODES:
        raise ValueError(f"{n_nodes} nodes are too many to send to every worker")
    path = stage_path(spark, "trees")
    trees.write().save(path)
    node, split = "nodeData", "nodeData.split"
    stored = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        *[F.col(f"{node}.{c}") for c in ("id", "prediction", "leftChild", "rightChild")],
        F.col(f"{split}.featureIndex").alias("feature"),
        F.col(f"{split}.numCategories").alias("categories"),
        F.get(f"{split}.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    )
    nodes = stored.toArrow().sort_by([("tree", "ascending"), ("id", "ascending")])
    columns = {name: nodes[name].fill_null(0).to_numpy() for name in nodes.column_names}
    if (columns["categories"] >= 0).any():
        raise ValueError("splits by category are not expected in these features")
    roots = np.flatnonzero(np.concatenate(([True], columns["tree"][1:] != columns["tree"][:-1])))
    start = np.repeat(roots, np.diff(np.append(roots, len(columns["id"]))))
    here = np.arange(len(start))
    leaf = columns["leftChild"] < 0
    weights = np.array(trees.treeWeights)
    if isinstance(trees, RandomForestRegressionModel):
        weights = weights / weights.sum()
    std = scaler.std.toArray()
    return ForestArrays(
        feature=np.where(leaf, 0, columns["feature"]).astype(np.int16),
        threshold=columns["threshold"],
        left=np.where(leaf, here, start + columns["leftChild"]).astype(np.int32),
        right=np.where(leaf, here, start + columns["rightChild"]).astype(np.int32),
        value=columns["prediction"],
        roots=roots.astype(np.int32),
        weights=weights,
        shift=scaler.mean.toArray(),
        scale=np.divide(1.0, std, out=np.zeros_like(std), where=std != 0),
        depth=max(tree.depth for tree in trees.trees),
    )


def series_to_step(rows: DataFrame, known: list[str], reach: int = REACH) -> DataFrame:
    """One row a series of split feature rows: the last training units, and the test days' known features.

    A series with fewer than ``reach`` training rows is left out.
    """
    train = F.when(F.col("part") == "train", F.struct("sale_date", "units"))
    values = F.array(*[F.col(name).cast("double") for name in known]).alias("known")
    test = F.when(F.col("part") == "test", F.struct("sale_date", "units", values))
    whole = rows.groupBy(*SERIES_KEYS).agg(F.sort_array(F.collect_list(train)).alias("train"), F.sort_array(F.collect_list(test)).alias("days"))
    return whole.where((F.size("train") >= reach) & (F.size("days") > 0)).select(
        *SERIES_KEYS, F.slice("train", -reach, reach)["units"].alias("past"), "days"
    )


def tree_multi_step(model: PipelineModel, rows: DataFrame, name: str = RANDOM_FOREST) -> DataFrame:
    """Predict every test day of split feature rows from the training part alone, never below 0.

    Each day's prediction, not its units, is what later days' lags and windows see.
    """
    spark = rows.sparkSession
    names = list(model.stages[0].getInputCols())
    known = [n for n in names if not n.startswith(("lag_", "rolling_"))]
    sent = spark.sparkContext.broadcast(forest_arrays(spark, model))  # MOST_NODES bounds it

    @F.pandas_udf("array<double>")
    def step(past: pd.Series, calendar: pd.Series) -> pd.Series:
        ahead = [np.array([np.asarray(day) for day in days]).reshape(-1, len(known)) for days in calendar]
        return pd.Series(days_ahead(sent.value, names, known, [np.asarray(p) for p in past], ahead))

    stepped = series_to_step(rows, known).withColumn("predicted", step("past", F.col("days.known")))
    each = stepped.select(*SERIES_KEYS, F.explode(F.arrays_zip("days", "predicted")).alias("day"))
    return each.select(
        *SERIES_KEYS,
        F.lit(name).alias("model"),
        F.lit(MULTI_STEP).alias("mode"),
        F.col("day.days.sale_date").alias("sale_date"),
        F.col("day.days.units").alias("actual"),
        F.col("day.predicted").alias("predicted"),
    ).select(*FORECAST_COLUMNS)
