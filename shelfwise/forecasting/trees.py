"""Tree ensembles on the feature matrix of all series.

One global model is trained. Lags and rolling means carry the level of each
series, so store and product need no index, whose label list would have to pass
through the driver. Features should come from a stored table (``staged``), since
training reads them several times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.forecasting import FORECAST_COLUMNS, ONE_STEP
from shelfwise.operators.features import FEATURES

RANDOM_FOREST = "random_forest"
GRADIENT_BOOSTING = "gradient_boosting"


def _fit(train: DataFrame, features: Sequence[str], regressor) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(features), outputCol="raw_features")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True)
    return Pipeline(stages=[assembler, scaler, regressor]).fit(train.select("units", *features))


def random_forest(
    train: DataFrame,
    features: Sequence[str] = FEATURES,
    num_trees: int = 200,
    max_depth: int = 15,
    min_leaf: int = 5,
    seed: int = 42,
    max_memory_mb: int = 256,
) -> PipelineModel:
    """Random forest over standardised features; every split looks at all features.

    ``max_memory_mb`` is what one task may hold of split statistics; more of it
    means fewer passes over the rows for many deep trees.
    """
    forest = RandomForestRegressor(
        labelCol="units",
        numTrees=num_trees,
        maxDepth=max_depth,
        minInstancesPerNode=min_leaf,
        featureSubsetStrategy="all",
        maxMemoryInMB=max_memory_mb,
        seed=seed,
    )
    return _fit(train, features, forest)


def gradient_boosting(
    train: DataFrame,
    features: Sequence[str] = FEATURES,
    stages: int = 200,
    max_depth: int = 5,
    learning_rate: float = 0.05,
    min_leaf: int = 5,
    seed: int = 42,
) -> PipelineModel:
    """Gradient-boosted trees over standardised features."""
    boosted = GBTRegressor(
        labelCol="units",
        maxIter=stages,
        maxDepth=max_depth,
        stepSize=learning_rate,
        minInstancesPerNode=min_leaf,
        seed=seed,
    )
    return _fit(train, features, boosted)


def tree_forecast(model: PipelineModel, rows: DataFrame, name: str = RANDOM_FOREST) -> DataFrame:
    """One-step predictions for feature rows, never below 0."""
    return (
        model.transform(rows)
        .withColumns(
            {
                "model": F.lit(name),
                "mode": F.lit(ONE_STEP),
                "actual": F.col("units"),
                "predicted": F.greatest("prediction", F.lit(0.0)),
            }
        )
        .select(*FORECAST_COLUMNS)
    )


def feature_importance(spark: SparkSession, model: PipelineModel, top: int | None = None) -> DataFrame:
    """Importance of each feature, largest first; one row per feature of the model."""
    names = model.stages[0].getInputCols()
    weights = model.stages[-1].featureImportances.toArray()
    rows = spark.createDataFrame(
        [(name, float(weight)) for name, weight in zip(names, weights)],
        "feature string, importance double",
    ).orderBy(F.desc("importance"), "feature")
    return rows if top is None else rows.limit(top)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
