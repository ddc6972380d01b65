"""Cleaning, duplicate accounting, category lookup and gap-free series."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.columns import non_negative, to_day
from shelfwise.schema import ROW_KEYS, SERIES_KEYS, day_window

# Fixed value: the category of products that have none.
DEFAULT_CATEGORY = "Otros"


# The text of a date that cannot be read, in a row's key.
UNREAD = "unread_date"


def with_readable_dates(df: DataFrame) -> DataFrame:
    """``df`` with dates for ``sale_date``, and with the text of those that cannot be read."""
    day = to_day(F.col("sale_date"), df.schema["sale_date"].dataType)
    unread = F.when(day.isNull(), F.col("sale_date").cast("string"))
    return df.withColumns({"sale_date": day, UNREAD: unread})


def clean_sales(
    df: DataFrame, first_by: Sequence[str] | None = None, ordered: bool = False
) -> DataFrame:
    """One row per sale date, store and product with numeric, non-negative measures.

    A date that cannot be read is part of its row's key as it stands: such rows
    stay, without a date, and only true copies of them go. Of several copies of a key the first one by ``first_by`` stays; the other
    columns break ties, so the choice never depends on the physical row order.
    Copies are reduced by an aggregate, not a window: every map task sends at
    most one row per key, however many copies one key has. ``ordered`` adds the
    report order, which later operators do not need.
    """
    rest = [name for name in df.columns if name not in ROW_KEYS]
    order = list(first_by or [])
    order += [name for name in rest if name not in order]
    first = with_readable_dates(df).groupBy(*ROW_KEYS, UNREAD).agg(F.min(F.struct(*order)).alias("first_row"))
    measures = {name: non_negative(F.col(name), df.schema[name].dataType) for name in ("units", "stock")}
    out = first.select(*ROW_KEYS, *[F.col(f"first_row.{name}") for name in rest]).withColumns(measures)
    return out.orderBy("store", "product", "sale_date") if ordered else out


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows before ``clean_sales``, rows after, and the difference."""
    per_key = with_readable_dates(df).groupBy(*ROW_KEYS, UNREAD).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    ).withColumn("duplicates", F.col("rows_before") - F.col("rows_after"))


def with_category(df: DataFrame, categories: DataFrame) -> DataFrame:
    """Look up each product's category in ``categories`` (product, category)."""
    lookup = categories.select("product", F.col("category").alias("looked_up"))
    return (
        df.drop("category")
        .join(lookup, "product", "left")
        .withColumn("category", F.coalesce("looked_up", F.lit(DEFAULT_CATEGORY)))
        .drop("looked_up")
    )


def dense_series(df: DataFrame, since: dt.date | None = None) -> DataFrame:
    """A row for every day between a series' first and last sale, gaps with 0 units.

    Each row spans the days up to the next sale of its series, so gaps are filled
    in the one shuffle that later series windows reuse; there is no calendar join
    and no second scan. Expects cleaned rows: a repeated day is an error.

    With ``since`` only that day and later come out, beside the ``series_start`` that the
    sold days before it tell; earlier gaps are never filled.
    """
    next_sale = F.lead("sale_date").over(day_window())
    spans = (
        df.where(F.col("sale_date").isNotNull())
        .select(*SERIES_KEYS, F.col("sale_date").alias("sold_on"), "sale_date", F.coalesce("units", F.lit(0.0)).alias("units"))
        .withColumn("last_day", F.coalesce(F.date_sub(next_sale, 1), "sale_date"))
    )
    own = []
    if since is not None:
        so_far = day_window().rowsBetween(Window.unboundedPreceding, 0)
        spans = spans.withColumn("series_start", F.min("sale_date").over(so_far)).where(F.col("last_day") >= F.lit(since))
        spans, own = spans.withColumn("sale_date", F.greatest("sale_date", F.lit(since))), ["series_start"]
    each_day = F.explode(F.sequence("sale_date", "last_day", F.expr("interval 1 day"))).alias("sale_date")
    return spans.select(*SERIES_KEYS, "sold_on", "units", *own, each_day).select(
        *SERIES_KEYS,
        "sale_date",
        F.when(F.col("sale_date") == F.col("sold_on"), F.col("units")).otherwise(0.0).alias("units"),
        *own,
    )


def one_series(df: DataFrame, store: str, product: str) -> DataFrame:
    """The gap-free series of one store and product; an error if it has no rows."""
    rows = df.where((F.col("store") == store) & (F.col("product") == product))
    if rows.isEmpty():
        raise ValueError(f"no rows for store={store!r}, product={product!r}")
    return dense_series(rows).orderBy("sale_date")
