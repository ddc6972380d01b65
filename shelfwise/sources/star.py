"""Sales facts from an order-line star schema.

Dimensions carry no broadcast hint. Spark broadcasts one when its size estimate
(or, under adaptive execution, its measured shuffle size) is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise uses a sort-merge join,
where adaptive execution splits a hot supplier or part over several tasks.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.columns import day_rows

# Holidays with the same date every year, as (month, day).
YEARLY_HOLIDAYS = [(1, 1), (1, 6), (5, 1), (8, 15), (10, 12), (11, 1), (12, 6), (12, 8), (12, 25)]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def supplier_stores(spark: SparkSession, folder: str) -> DataFrame:
    """Which store (region) each supplier delivers to."""
    return (
        table(spark, folder, "supplier")
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", F.col("r_name").alias("store"))
    )


def sales_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line: store = region, product = part, category = part type."""
    return (
        table(spark, folder, "lineitem")
        .join(supplier_stores(spark, folder), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_shipdate").cast("date").alias("sale_date"),
            "store",
            F.col("l_partkey").alias("product"),
            F.col("p_type").alias("category"),
            F.col("l_quantity").alias("units"),
            F.col("p_size").alias("stock"),
        )
    )


def sales_daily(spark: SparkSession, folder: str) -> DataFrame:
    """One row per day, store and part type; the part type is the product.

    Lines are summed on the map side first, so a day or store that holds most
    of the lines still shuffles at most one row per group and task.
    """
    return (
        sales_lines(spark, folder)
        .groupBy("sale_date", "store", F.col("category").alias("product"))
        .agg(F.sum("units").alias("units"), F.sum("stock").alias("stock"))
        .withColumn("category", F.col("product"))
    )


def part_daily(spark: SparkSession, folder: str) -> DataFrame:
    """One row per day, store and part: many short series instead of few long ones."""
    return (
        sales_lines(spark, folder)
        .groupBy("sale_date", "store", "product", "category")
        .agg(F.sum("units").alias("units"), F.sum("stock").alias("stock"))
    )


def raw_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as an uncleaned feed: text measures, repeated keys, returns below zero.

    Some dates carry a time of day and some cannot be read.

    The product is the part type, so a day of one store holds many copies of a key.
    """
    return (
        table(spark, folder, "lineitem")
        .join(supplier_stores(spark, folder), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.when(F.col("l_linenumber") == 5, F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
            .when(F.col("l_linenumber") == 6, F.date_format("l_shipdate", "dd.MM.yyyy"))
            .when(F.col("l_linenumber") == 7, F.lit("soon"))
            .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
            .alias("sale_date"),
            "store",
            F.col("p_type").alias("product"),
            F.col("p_type").alias("category"),
            F.when(F.col("l_returnflag") == "R", F.concat(F.lit("-"), F.col("l_quantity").cast("int")))
            .when(F.col("l_discount") == 0, F.lit("n/a"))
            .otherwise(F.col("l_quantity").cast("int").cast("string"))
            .alias("units"),
            F.when(F.col("l_tax") == 0, F.lit("")).otherwise(F.col("p_size").cast("string")).alias("stock"),
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
        )
    )


def yearly_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """The fixed-date holidays of a span of years, as an input table."""
    days = [
        dt.date(year, month, day)
        for year in range(first_year, last_year + 1)
        for month, day in YEARLY_HOLIDAYS
    ]
    return day_rows(spark, days, "holiday")
