"""Store overview figures and the dataset profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.columns import full_window, weekday

# Short day names, Monday first.
DAY_NAMES = ["Lun", "Mar", "Mié", "Jue", "Vie", "Sáb", "Dom"]


def store_kpis(df: DataFrame) -> DataFrame:
    """Total units, mean of the daily totals, distinct products and mean stock per store.

    The mean of the daily totals is the total over the number of days, so one
    aggregate serves all figures. Its map side already reduces a busy store to
    one row per day and per product before anything is shuffled.
    """
    return df.groupBy("store").agg(
        F.sum("units").alias("units_total"),
        (F.sum("units") / F.countDistinct("sale_date")).alias("units_per_day"),
        F.countDistinct("product").alias("distinct_products"),
        F.avg("stock").alias("stock_mean"),
    )


def daily_total_moving_average(df: DataFrame, rows: int = 7) -> DataFrame:
    """Daily units per store with a moving average that needs ``rows`` full days of sales.

    The window follows the daily sums, so a store holds one row per day in it.
    """
    frame = Window.partitionBy("store").orderBy("sale_date").rowsBetween(1 - rows, 0)
    mean = full_window(F.avg("units").over(frame), F.count("units").over(frame), rows)
    return (
        df.groupBy("store", "sale_date")
        .agg(F.sum("units").alias("units"))
        .withColumn(f"moving_average_{rows}", mean)
    )


def category_sales(df: DataFrame) -> DataFrame:
    """Units per store and category, largest first within a store."""
    return (
        df.groupBy("store", "category")
        .agg(F.sum("units").alias("units"))
        .orderBy("store", F.desc("units"), "category")
    )


def dow_seasonality(df: DataFrame) -> DataFrame:
    """Mean units per store and day of week, with the day's name."""
    names = F.array(*[F.lit(name) for name in DAY_NAMES])
    return (
        df.groupBy("store", weekday(F.col("sale_date")).alias("dow"))
        .agg(F.avg("units").alias("units_mean"))
        .withColumn("day_name", F.get(names, F.col("dow")))
    )


def dataset_profile(df: DataFrame) -> DataFrame:
    """Rows, distinct stores and products, date range and mean units.

    A first aggregate per series shrinks the input of the two distinct counts
    from all rows to one row per series.
    """
    per_series = df.groupBy("store", "product").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("sale_date").alias("first_day"),
        F.max("sale_date").alias("last_day"),
        F.sum("units").alias("units"),
        F.count("units").alias("unit_rows"),
    )
    return per_series.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.countDistinct("store").alias("stores"),
        F.countDistinct("product").alias("products"),
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
        (F.sum("units") / F.nullif(F.sum("unit_rows"), F.lit(0))).alias("units_mean"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column, sorted."""
    return df.select(column).distinct().orderBy(column)
