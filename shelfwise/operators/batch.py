"""Batch aggregates, rankings and stock alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.columns import iso_year
from shelfwise.schema import SERIES_KEYS, day_window, series_window

# Stock states, most urgent first.
CRITICAL, LOW, OK = "CRITICO", "BAJO", "OK"


def daily_store_aggregates(df: DataFrame, cleaned: bool = False) -> DataFrame:
    """Units, distinct products, mean units, stock and holiday flag per day and store.

    In ``cleaned`` rows a product appears once per day and store, so counting it
    equals counting it distinctly and only partial sums are shuffled, not every
    (day, store, product).
    """
    products = F.count("product") if cleaned else F.countDistinct("product")
    return (
        df.groupBy("sale_date", "store")
        .agg(
            F.sum("units").alias("units_total"),
            products.alias("distinct_products"),
            F.avg("units").alias("units_mean"),
            F.sum("stock").alias("stock_total"),
            F.max("is_holiday").alias("is_holiday"),
        )
        .orderBy("store", "sale_date")
    )


def weekly_category_stats(df: DataFrame, iso_years: bool = False) -> DataFrame:
    """Weekly units per category: sum, mean, sample deviation and row count.

    By default the calendar year is paired with the ISO week, so 1 January can
    land in week 52 beside that year's December. ``iso_years`` uses the year the
    week belongs to.
    """
    day = F.col("sale_date")
    year = iso_year(day) if iso_years else F.year(day)
    return (
        df.groupBy(year.alias("year"), F.weekofyear(day).alias("week"), "category")
        .agg(
            F.sum("units").alias("units_week"),
            F.avg("units").alias("units_mean"),
            F.stddev_samp("units").alias("units_std"),
            F.count(F.lit(1)).alias("row_count"),
        )
        .orderBy("year", "week", "category")
    )


def top_products_by_store(df: DataFrame, top_n: int = 5) -> DataFrame:
    """The products with most units per store; ties at the last rank all stay.

    The rank filter becomes a group limit before the shuffle, so a store with
    most of the products sends only its leaders to the ranking task.
    """
    by_total = Window.partitionBy("store").orderBy(F.desc("total_units"))
    return (
        df.groupBy("store", "product", "category")
        .agg(F.sum("units").alias("total_units"))
        .withColumn("rank", F.rank().over(by_total))
        .where(F.col("rank") <= top_n)
        .orderBy("store", "rank", "product")
    )


def rolling_mean_range(df: DataFrame, days: int = 7, inclusive_days: bool = False) -> DataFrame:
    """Mean units of a series over a range of days ending at the row's own day.

    The range counts back ``days`` whole days with both ends included, so 7 days
    back span up to 8 calendar days; ``inclusive_days`` makes it ``days`` in all.
    Days, not seconds, so clock changes do not shorten the range.
    """
    back = days - 1 if inclusive_days else days
    frame = series_window().orderBy(F.unix_date("sale_date")).rangeBetween(-back, 0)
    return df.withColumn(f"rolling_mean_{days}d", F.avg("units").over(frame))


def rolling_mean_range_lines(df: DataFrame, days: int = 7, inclusive_days: bool = False) -> DataFrame:
    """``rolling_mean_range`` for a frame with any number of rows per day.

    Sums and counts per day come first, so the window sees at most one row per
    day even if a single series holds most of the lines. The means then join
    back to the lines; adaptive execution splits a hot day of that join.
    """
    back = days - 1 if inclusive_days else days
    frame = series_window().orderBy(F.unix_date("sale_date")).rangeBetween(-back, 0)
    observed = F.sum("day_count").over(frame)
    daily = (
        df.groupBy(*SERIES_KEYS, "sale_date")
        .agg(F.sum("units").alias("day_units"), F.count("units").alias("day_count"))
        .select(
            *SERIES_KEYS,
            "sale_date",
            F.when(observed > 0, F.sum("day_units").over(frame) / observed).alias(f"rolling_mean_{days}d"),
        )
    )
    return df.join(daily, [*SERIES_KEYS, "sale_date"], "left")


def stock_state(stock: Column, mean_units: Column, alert_ratio: float) -> Column:
    return (
        F.when(stock < mean_units * alert_ratio, CRITICAL).when(stock < mean_units, LOW).otherwise(OK)
    )


def stock_alerts(df: DataFrame, alert_ratio: float = 0.3, rows: int = 7) -> DataFrame:
    """Compare each row's stock with the mean units of the previous rows of its series.

    The frame counts rows, not days, leaves out the current row and may be
    partial; a first row has no mean and is OK.
    """
    previous = day_window().rowsBetween(-rows, -1)
    with_mean = df.withColumn(f"units_mean_prev{rows}", F.avg("units").over(previous))
    state = stock_state(F.col("stock"), F.col(f"units_mean_prev{rows}"), alert_ratio)
    return with_mean.withColumn("state", state)


def stock_alerts_report(alerts: DataFrame, ordered: bool = True) -> DataFrame:
    """Critical and low rows of ``stock_alerts``, latest first.

    A large report is better written without ``ordered``: a global sort reads its
    input twice, and readers of the latest rows need a top-k only.
    """
    means = [name for name in alerts.columns if name.startswith("units_mean_prev")]
    rows = alerts.where(F.col("state").isin(CRITICAL, LOW)).select(
        "sale_date", "store", "product", "stock", *means, "state"
    )
    return rows.orderBy(F.desc("sale_date"), "store", "product") if ordered else rows


def latest_alerts(alerts: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` latest rows of the alert report."""
    return stock_alerts_report(alerts).limit(n)


def alert_counts(alerts: DataFrame) -> DataFrame:
    """Rows per stock state, over all alerts and not only the reported ones."""
    return alerts.groupBy("state").agg(F.count(F.lit(1)).alias("rows"))


def output_row_counts(outputs: dict[str, DataFrame]) -> DataFrame:
    """Row count of each named output."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("output"), "rows")
        for name, df in outputs.items()
    ]
    stacked = counts[0]
    for one in counts[1:]:
        stacked = stacked.unionByName(one)
    return stacked
