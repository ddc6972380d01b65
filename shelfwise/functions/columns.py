"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_day(col: Column, data_type: T.DataType) -> Column:
    """A date from text, timestamp or date; text that is no date gives null.

    Text may leave out leading zeros and may go on with a time of day.
    """
    if isinstance(data_type, T.StringType):
        return F.when(F.trim(col).rlike(r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:.*)?$"), F.trim(col).try_cast("date"))
    return col.cast("date")


def non_negative(col: Column, data_type: T.DataType) -> Column:
    """Numeric coercion: text that is no number, NaN and null give 0; clamp at 0.

    Integer columns keep their type, anything else becomes a double.
    """
    if isinstance(data_type, T.IntegralType):
        zero = F.lit(0).cast(data_type)
        return F.greatest(F.coalesce(col, zero), zero)
    number = F.nanvl(col.try_cast("double"), F.lit(None).cast("double"))
    return F.greatest(F.coalesce(number, F.lit(0.0)), F.lit(0.0))


def weekday(day: Column) -> Column:
    """Day of week with Monday = 0."""
    return F.weekday(day)


def iso_year(day: Column) -> Column:
    """The year an ISO week belongs to."""
    return F.extract(F.lit("YEAROFWEEK"), day)


def padded_code(prefix: str, number: Column, width: int) -> Column:
    """A code such as ``PROD_007``."""
    return F.format_string(f"{prefix}_%0{width}d", number)


def code_number(code: Column) -> Column:
    """The number at the end of a code; null where there is none."""
    return F.regexp_extract(code, r"_(\d+)$", 1).try_cast("long")


def flag(condition: Column) -> Column:
    return condition.cast("int")


def is_black_friday(day: Column) -> Column:
    """November Fridays from the 23rd on; two of them when the 30th is a Friday."""
    return (F.month(day) == 11) & (weekday(day) == 4) & (F.dayofmonth(day) >= 23)


def full_window(value: Column, observed: Column, size: int) -> Column:
    """``value`` only where the frame held ``size`` observations, else null."""
    return F.when(observed == size, value)


def rows_since(df: DataFrame, day: dt.date) -> DataFrame:
    """Rows of a day and later; of a table written by month, only those months are read."""
    rows = df.where(F.col("sale_date") >= day)
    if "sale_month" in df.columns:
        rows = rows.where(F.col("sale_month") >= day.strftime("%Y-%m"))
    return rows


def train_rows(total: Column, test_fraction: float) -> Column:
    """Rows in the training part of ``total`` rows, in double arithmetic."""
    return F.floor(total * F.lit(1 - test_fraction))


def day_rows(spark: SparkSession, days: Iterable[dt.date], name: str) -> DataFrame:
    """A one-column table of dates, built in the JVM."""
    literals = F.array(*[F.lit(day) for day in days])
    return spark.range(0, 1, 1, 1).select(F.explode(literals).alias(name))
