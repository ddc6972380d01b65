"""Moving-average forecast: the mean of the last training days, held constant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.forecasting import FORECAST_COLUMNS, MULTI_STEP
from shelfwise.operators.features import with_row_numbers
from shelfwise.schema import SERIES_KEYS, series_window


def moving_average_fit(dense: DataFrame, window: int = 7, test_fraction: float = 0.2) -> DataFrame:
    """Per series: the last training day and the mean of the last ``window`` training days."""
    rows = with_row_numbers(dense, test_fraction).where(F.col("row_no") <= F.col("n_train"))
    in_tail = F.col("row_no") > F.col("n_train") - window
    return rows.groupBy(*SERIES_KEYS).agg(
        F.max("sale_date").alias("train_end"), F.avg(F.when(in_tail, F.col("units"))).alias("level")
    )


def moving_average_predict(fit: DataFrame, horizon: int, window: int = 7) -> DataFrame:
    """The fitted level for each of the ``horizon`` days after the training part."""
    step = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    return fit.select(*SERIES_KEYS, "train_end", "level", step.alias("step")).select(
        *SERIES_KEYS,
        F.lit(f"moving_average_{window}d").alias("model"),
        F.lit(MULTI_STEP).alias("mode"),
        F.date_add("train_end", F.col("step")).alias("sale_date"),
        F.col("level").alias("predicted"),
    )


def moving_average_forecast(dense: DataFrame, window: int = 7, test_fraction: float = 0.2) -> DataFrame:
    """Predict every test day of every series, in the shuffle that ordered the series."""
    rows = with_row_numbers(dense, test_fraction)
    in_tail = (F.col("row_no") <= F.col("n_train")) & (F.col("row_no") > F.col("n_train") - window)
    return (
        rows.withColumn("predicted", F.avg(F.when(in_tail, F.col("units"))).over(series_window()))
        .where(F.col("row_no") > F.col("n_train"))
        .withColumns(
            {
                "model": F.lit(f"moving_average_{window}d"),
                "mode": F.lit(MULTI_STEP),
                "actual": F.col("units"),
            }
        )
        .select(*FORECAST_COLUMNS)
    )
