"""Who a series is, as numbers that a global model can split on, from earlier days only.

A day's ``series_level`` is the mean of the series' units on all earlier days, shrunk to its
store's: ``strength`` days of the store's level are added to it. The store's level
is shrunk to that of all sales in the same way. No number of a day depends on that
day or a later one, so training and test rows are encoded alike and nothing leaks.

Days per store and days over all are summed on the map side first. What the running sums see is
a row a day and store, and a row a day, however many series there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.schema import SERIES_KEYS, day_window

STRENGTH = 20.0
LEVELS = ["series_level", "store_level"]


def _shrunk(total: Column, days: Column, prior: Column, strength: float) -> Column:
    return (total + F.lit(strength) * prior) / (days + F.lit(strength))


def _before(column: str, window) -> Column:
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))


def store_levels(dense: DataFrame, strength: float = STRENGTH) -> DataFrame:
    """(store, sale_date, store_level) for each day on which a store has rows."""
    daily = dense.groupBy("store", "sale_date").agg(F.sum("units").alias("day_units"), F.count("*").cast("double").alias("day_rows"))
    all_days = daily.groupBy("sale_date").agg(F.sum("day_units").alias("day_units"), F.sum("day_rows").alias("day_rows"))
    # A row a day: the calendar bounds what this window without keys sees.
    calendar = Window.orderBy("sale_date")
    overall = all_days.select("sale_date", F.try_divide(_before("day_units", calendar), _before("day_rows", calendar)).alias("level"))
    of_store = Window.partitionBy("store").orderBy("sale_date")
    known = daily.select("store", "sale_date", _before("day_units", of_store).alias("total"), _before("day_rows", of_store).alias("days"))
    prior = F.coalesce("level", F.lit(0.0))
    level = _shrunk(F.col("total"), F.col("days"), prior, strength)
    return known.join(overall, "sale_date").select("store", "sale_date", level.alias("store_level"))


def with_series_levels(rows: DataFrame, dense: DataFrame | None = None, strength: float = STRENGTH) -> DataFrame:
    """Add ``series_level`` and ``store_level`` to the rows of dense series.

    ``dense`` has the days that count where ``rows`` holds some of them only.
    """
    days = rows if dense is None else dense
    total, n = F.sum("units"), F.count("units")
    earlier = day_window().rowsBetween(Window.unboundedPreceding, -1)
    own = days.select(
        *SERIES_KEYS, "sale_date", F.coalesce(total.over(earlier), F.lit(0.0)).alias("own_total"), n.over(earlier).cast("double").alias("own_days")
    )
    both = own.join(store_levels(days, strength), ["store", "sale_date"])
    level = _shrunk(F.col("own_total"), F.col("own_days"), F.col("store_level"), strength)
    found = both.select(*SERIES_KEYS, "sale_date", level.alias("series_level"), "store_level")
    return rows.drop(*LEVELS).join(found, [*SERIES_KEYS, "sale_date"])
