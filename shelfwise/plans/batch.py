"""The batch job: a sales feed in, four reports out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import batch
from shelfwise.operators.cleaning import clean_sales
from shelfwise.schema import with_report_names
from shelfwise.sources.files import FEED_POSITION, read_sales_csv, write_table


@dataclass(frozen=True)
class BatchResult:
    paths: dict[str, str]
    critical_alerts: int


def cleaned_feed(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A cleaned feed: CSV, or a table that already has the fact's column names.

    Of several copies of a key in a CSV file the first line stays.
    """
    if fmt != "csv":
        return clean_sales(spark.read.format(fmt).load(path))
    feed = read_sales_csv(spark, path, raw=True, positions=True)
    return clean_sales(feed, FEED_POSITION).drop(*FEED_POSITION)


def run_batch(
    spark: SparkSession,
    feed: str,
    out: str,
    feed_format: str = "csv",
    report_format: str = "parquet",
    report_names: bool = False,
    top_n: int = 5,
    alert_ratio: float = 0.3,
) -> BatchResult:
    """Clean the feed once, write it by month, and write the reports from that table.

    The cleaned table on shared storage takes the place of a cache: it is
    columnar, larger than memory may hold, and stays when an executor is lost.
    The critical count reads the written report, so alerts are computed once.
    Alerts, the one report that grows with the feed, are written by month.
    ``report_names`` instead writes all reports with the headers and in the order
    that their consumers expect.
    """
    cleaned_path = write_table(cleaned_feed(spark, feed, feed_format), f"{out}/clean_sales", "sale_date")
    cleaned = spark.read.parquet(cleaned_path)
    alerts = batch.stock_alerts(cleaned, alert_ratio)
    reports = {
        "daily_store_aggregates": batch.daily_store_aggregates(cleaned, cleaned=True),
        "weekly_category_stats": batch.weekly_category_stats(cleaned),
        "top_products_by_store": batch.top_products_by_store(cleaned, top_n),
        "stock_alerts": batch.stock_alerts_report(alerts, ordered=report_names),
    }
    paths = {"clean_sales": cleaned_path}
    for name, report in reports.items():
        named = with_report_names(report, name) if report_names else report
        month_of = "sale_date" if name == "stock_alerts" and not report_names else None
        paths[name] = write_table(named, f"{out}/{name}", month_of, report_format)
    stored = spark.read.format(report_format).option("header", True).load(paths["stock_alerts"])
    state = "alerta_stock" if report_names else "state"
    critical = stored.where(F.col(state) == batch.CRITICAL).count()
    return BatchResult(paths, critical)


def stored_row_counts(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """Row count of each written output; for parquet Spark reads no column to count."""
    return batch.output_row_counts(
        {name: spark.read.format(fmt).option("header", True).load(path) for name, path in paths.items()}
    )
