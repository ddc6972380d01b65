"""Calendar, lag and rolling features, temporal splits, scaling and lookback windows.

Everything per series shares one partitioning (store, product) and one order
(sale date), so Spark shuffles and sorts a dense series once for all of it. No
feature of a day looks at that day's own units or at a later day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.columns import (
    flag,
    full_window,
    is_black_friday,
    rows_since,
    train_rows,
    weekday,
)
from shelfwise.schema import SERIES_KEYS, day_window, series_window

# Lags and rolling windows in rows; the window whose maximum is kept.
LAGS = [1, 7, 14, 21, 28]
ROLLING_WINDOWS = [7, 14, 30]
ROLLING_MAX_WINDOW = 7

# National holidays of the two sample years.
HOLIDAYS_2022_2023 = [
    dt.date(2022, 1, 1), dt.date(2022, 1, 6), dt.date(2022, 4, 15), dt.date(2022, 5, 1),
    dt.date(2022, 8, 15), dt.date(2022, 10, 12), dt.date(2022, 11, 1), dt.date(2022, 12, 6),
    dt.date(2022, 12, 8), dt.date(2022, 12, 25),
    dt.date(2023, 1, 1), dt.date(2023, 1, 6), dt.date(2023, 4, 7), dt.date(2023, 5, 1),
    dt.date(2023, 8, 15), dt.date(2023, 10, 12), dt.date(2023, 11, 1), dt.date(2023, 12, 6),
    dt.date(2023, 12, 8), dt.date(2023, 12, 25),
]

# Demand factors by day of week (Monday first) and month (January first),
# on holidays, on Black Friday, and the yearly growth.
WEEKDAY_FACTORS = [0.85, 0.88, 0.92, 0.95, 1.20, 1.35, 0.85]
MONTH_FACTORS = [0.90, 0.85, 0.95, 0.98, 1.00, 1.05, 1.10, 0.80, 1.00, 1.05, 1.20, 1.40]
HOLIDAY_FACTOR = 0.30
BLACK_FRIDAY_FACTOR = 2.5
YEARLY_GROWTH = 0.02

CALENDAR_FEATURES = [
    "dow", "month", "iso_week", "quarter", "is_weekend", "is_month_start", "is_month_end",
    "is_holiday", "is_day_after_holiday", "is_black_friday",
]


def rolling_names(windows: Sequence[int] = ROLLING_WINDOWS) -> list[str]:
    names = []
    for size in windows:
        names += [f"rolling_mean_{size}", f"rolling_std_{size}"]
        if size == ROLLING_MAX_WINDOW:
            names.append(f"rolling_max_{size}")
    return names


FEATURES = [
    *CALENDAR_FEATURES,
    "days_since_start",
    *[f"lag_{k}" for k in LAGS],
    *rolling_names(),
]


def holiday_marks(holidays: DataFrame) -> DataFrame:
    """One row per marked day from ``holidays`` (holiday): the day itself and the day after."""
    days = holidays.select(F.col("holiday").cast("date").alias("sale_date"))
    on = days.select("sale_date", F.lit(1).alias("on_day"), F.lit(0).alias("after_day"))
    after = days.select(F.date_add("sale_date", 1), F.lit(0), F.lit(1))
    return on.union(after).groupBy("sale_date").agg(
        F.max("on_day").alias("is_holiday"), F.max("after_day").alias("is_day_after_holiday")
    )


def with_holiday_flag(df: DataFrame, holidays: DataFrame) -> DataFrame:
    """Add ``is_holiday`` (0 or 1)."""
    marks = holiday_marks(holidays).drop("is_day_after_holiday")
    return (
        df.drop("is_holiday")
        .join(marks, "sale_date", "left")
        .withColumn("is_holiday", F.coalesce("is_holiday", F.lit(0)))
    )


def add_calendar_features(df: DataFrame, holidays: DataFrame) -> DataFrame:
    """The ten calendar features of each row's sale date.

    Only holidays need a join, one for both holiday flags; the rest is computed
    in place.
    """
    day = F.col("sale_date")
    return (
        df.drop(*CALENDAR_FEATURES)
        .join(holiday_marks(holidays), "sale_date", "left")
        .withColumns(
            {
                "dow": weekday(day),
                "month": F.month(day),
                "iso_week": F.weekofyear(day),
                "quarter": F.quarter(day),
                "is_weekend": flag(weekday(day) >= 5),
                "is_month_start": flag(F.dayofmonth(day) <= 5),
                "is_month_end": flag(F.dayofmonth(day) >= 25),
                "is_holiday": F.coalesce("is_holiday", F.lit(0)),
                "is_day_after_holiday": F.coalesce("is_day_after_holiday", F.lit(0)),
                "is_black_friday": flag(is_black_friday(day)),
            }
        )
    )


def add_lags(df: DataFrame, lags: Sequence[int] = LAGS) -> DataFrame:
    """Units of earlier rows of the series."""
    return df.withColumns({f"lag_{k}": F.lag("units", k).over(day_window()) for k in lags})


def _earlier_parts(size: int, smaller: int) -> tuple[dict[str, Column], list[tuple[int, Column, Column]]]:
    """The parts of a window: whole windows of the next smaller size, then single rows.

    Returns the lagged columns to add and, per part, its rows, mean and squared
    deviations.
    """
    whole, rest = divmod(size, smaller)
    mean, squares, day = f"rolling_mean_{smaller}", f"squares_{smaller}", day_window()
    lagged = {}
    parts = [(smaller, F.col(mean), F.col(squares))]
    for i in range(1, whole):
        lagged[f"mean_{i}"] = F.lag(mean, i * smaller).over(day)
        lagged[f"squares_{i}"] = F.lag(squares, i * smaller).over(day)
        parts.append((smaller, F.col(f"mean_{i}"), F.col(f"squares_{i}")))
    for i in range(rest):
        lagged[f"row_{i}"] = F.lag("units", whole * smaller + 1 + i).over(day)
        parts.append((1, F.col(f"row_{i}"), F.lit(0.0)))
    return lagged, parts


def _previous(function: Callable[[str], Column], size: int) -> Column:
    """``function`` of the units of the previous ``size`` rows, where there are as many."""
    frame = day_window().rowsBetween(-size, -1)
    return full_window(function("units").over(frame), F.count("units").over(frame), size)


def add_rolling(df: DataFrame, windows: Sequence[int] = ROLLING_WINDOWS) -> DataFrame:
    """Mean, sample deviation and maximum of the previous rows, where a window is full.

    Only the smallest window slides over its rows. A larger one is put together
    from whole earlier windows of the next smaller size and the few rows that
    remain, so its cost hardly grows with its length. Means and squared
    deviations of the parts combine without the cancellation of running totals.
    """
    rows, smaller = df, None
    if ROLLING_MAX_WINDOW in windows:
        rows = df.withColumn(f"rolling_max_{ROLLING_MAX_WINDOW}", _previous(F.max, ROLLING_MAX_WINDOW))
    for size in sorted(set(windows)):
        mean, squares = f"rolling_mean_{size}", f"squares_{size}"
        if smaller is None:
            rows = rows.withColumns(
                {mean: _previous(F.avg, size), squares: _previous(F.var_pop, size) * size}
            )
        else:
            lagged, parts = _earlier_parts(size, smaller)
            total = sum((part_mean * n for n, part_mean, _ in parts), F.lit(0.0))
            spread = sum(
                (inside + F.pow(part_mean - F.col(mean), F.lit(2)) * n for n, part_mean, inside in parts),
                F.lit(0.0),
            )
            rows = rows.withColumns(lagged).withColumn(mean, total / size)
            rows = rows.withColumn(squares, spread).drop(*lagged)
        degrees = F.nullif(F.lit(size - 1.0), F.lit(0.0))
        rows = rows.withColumn(f"rolling_std_{size}", F.sqrt(F.col(squares) / degrees))
        smaller = size
    return rows.select(*df.columns, *rolling_names(windows))


def add_history_features(dense: DataFrame) -> DataFrame:
    """Lags, rolling features and days since the start of each dense series; keeps all rows.

    A ``series_start`` column, where present, is taken as the first day.
    """
    rows = dense
    if "series_start" not in dense.columns:
        so_far = day_window().rowsBetween(Window.unboundedPreceding, 0)
        rows = dense.withColumn("series_start", F.min("sale_date").over(so_far))
    rows = add_rolling(add_lags(rows))
    return rows.withColumn("days_since_start", F.datediff("sale_date", "series_start")).drop("series_start")


def complete_features(df: DataFrame) -> DataFrame:
    """Rows with a full history: every feature the frame holds has a value."""
    return df.dropna(subset=available_features(df))


def reach_before(day: dt.date) -> dt.date:
    """The first day that a day's lags and windows look at."""
    return day - dt.timedelta(days=max(LAGS + ROLLING_WINDOWS))


def feature_matrix(
    dense: DataFrame, holidays: DataFrame, from_date: dt.date | None = None
) -> DataFrame:
    """All features of every dense series; rows without a full history are dropped.

    With ``from_date`` only that day and later are returned, and of a stored
    series only the days are read that the longest window reaches back to: a
    plain filter on the date could not move below the windows. Series that
    ``dense_series`` made since ``reach_before`` that day bring their starts along and are read once.
    """
    rows = dense
    if from_date is not None and "series_start" not in dense.columns:
        reach = dt.timedelta(days=max(LAGS + ROLLING_WINDOWS))
        starts = dense.groupBy(*SERIES_KEYS).agg(F.min("sale_date").alias("series_start"))
        rows = rows_since(dense, from_date - reach).join(starts, SERIES_KEYS)
    rows = complete_features(add_history_features(rows))
    if from_date is not None:
        rows = rows.where(F.col("sale_date") >= from_date)
    return add_calendar_features(rows, holidays).select(*SERIES_KEYS, "sale_date", "units", *FEATURES)


def available_features(df: DataFrame) -> list[str]:
    """The known features that a frame holds, in feature order."""
    return [name for name in FEATURES if name in df.columns]


def with_row_numbers(df: DataFrame, test_fraction: float = 0.2) -> DataFrame:
    """Add each row's position in its series and how many rows the series trains on."""
    total = F.count(F.lit(1)).over(series_window())
    return df.withColumns(
        {
            "row_no": F.row_number().over(day_window()),
            "n_train": train_rows(total, test_fraction),
        }
    )


def temporal_split(df: DataFrame, test_fraction: float = 0.2) -> DataFrame:
    """Mark the first rows of each series ``train`` and its last rows ``test``."""
    part = F.when(F.col("row_no") <= F.col("n_train"), "train").otherwise("test")
    return with_row_numbers(df, test_fraction).withColumn("part", part).drop("row_no", "n_train")


def min_max_scaled(split: DataFrame) -> DataFrame:
    """Scale a split series to [0, 1] by the range of its training rows.

    Keeps the bounds, so predictions can be scaled back. A constant series
    scales to 0.
    """
    in_train = F.when(F.col("part") == "train", F.col("units"))
    with_bounds = split.withColumns(
        {"scale_min": F.min(in_train).over(series_window()), "scale_max": F.max(in_train).over(series_window())}
    )
    return with_bounds.withColumn("scaled", scale(F.col("units"), F.col("scale_min"), F.col("scale_max")))


def standardised(split: DataFrame, names: Sequence[str] = FEATURES) -> DataFrame:
    """Each named feature less its mean over the training rows, by their deviation (of the population).

    A constant feature becomes 0. Means and deviations are two numbers a feature, from one
    aggregate; they enter the plan as constants, so rows are scaled where they are read.
    """
    train = split.where(F.col("part") == "train")
    sums = [column for n in names for column in (F.avg(n).alias(f"mean_{n}"), F.stddev_pop(n).alias(f"std_{n}"))]
    found = train.agg(*sums).first()

    def scaled(name: str) -> Column:
        mean, std = found[f"mean_{name}"], found[f"std_{name}"]
        return (F.col(name) - F.lit(mean).cast("double")) / F.lit(std or 1.0)

    return split.withColumns({name: scaled(name) for name in names})


def scale(value: Column, low: Column, high: Column) -> Column:
    return F.when(high == low, value - low).otherwise((value - low) / F.nullif(high - low, F.lit(0.0)))


def unscale(value: Column, low: Column, high: Column) -> Column:
    return F.when(high == low, value + low).otherwise(value * (high - low) + low)


def lookback_sequences(scaled: DataFrame, lookback: int = 30) -> DataFrame:
    """Each row's previous ``lookback`` scaled values, oldest first, with its own as target.

    Rows with a shorter history are left out.
    """
    previous = F.collect_list("scaled").over(day_window().rowsBetween(-lookback, -1))
    return (
        scaled.withColumn("lookback", previous)
        .where(F.size("lookback") == lookback)
        .withColumn("target", F.col("scaled"))
    )


def validation_split(sequences: DataFrame, fraction: float = 0.15) -> DataFrame:
    """Mark the last sequences of each series' training part ``validation``, at least one."""
    train = sequences.where(F.col("part") == "train")
    total = F.count(F.lit(1)).over(series_window())
    held_out = F.greatest(F.lit(1), F.floor(total * F.lit(fraction)))
    role = F.when(F.row_number().over(day_window()) <= total - held_out, "fit").otherwise("validation")
    return train.withColumn("role", role)


def seasonal_index(day: Column, holiday: Column, origin: dt.date) -> Column:
    """Expected demand of a day relative to a plain day at ``origin``."""
    by_weekday = F.array(*[F.lit(x) for x in WEEKDAY_FACTORS])
    by_month = F.array(*[F.lit(x) for x in MONTH_FACTORS])
    trend = 1.0 + YEARLY_GROWTH * (F.datediff(day, F.lit(origin)) / 365.0)
    return (
        trend
        * F.get(by_weekday, weekday(day))
        * F.get(by_month, F.month(day) - 1)
        * F.when(holiday == 1, HOLIDAY_FACTOR).otherwise(1.0)
        * F.when(is_black_friday(day), BLACK_FRIDAY_FACTOR).otherwise(1.0)
    )


def deseasonalised_sales(df: DataFrame, holidays: DataFrame, origin: dt.date) -> DataFrame:
    """Units divided by the seasonal index of their day."""
    index = seasonal_index(F.col("sale_date"), F.col("is_holiday"), origin)
    return (
        with_holiday_flag(df, holidays)
        .withColumn("seasonal_index", index)
        .withColumn("units_deseasonalised", F.col("units") / F.col("seasonal_index"))
    )
