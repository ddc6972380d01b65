"""The batch job a feed at a time: only the months that a feed adds to are written again.

``update_batch`` cleans a feed, drops what earlier feeds have brought already, and merges the rest
into the stored months that it touches. Reports follow by month (alerts, daily aggregates,
product totals) or by year (weekly statistics); the ranking of products reads the monthly totals
only. Files of other months stay as they are.

Alerts look back seven rows of a series, which may lie in any earlier month. Each month
keeps the last seven rows of the series that it has rows of, so the rows before the first
touched month come from there and not from old facts. Later months are
read, but written only where one of a row's seven earlier rows, or the row itself, lies in a
month that its series has new rows of.

A note of the touched months is written first and removed last. A run that ends in between
leaves it, and the next run writes those months' reports again. Two updates of one folder
must not run at the same time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import batch
from shelfwise.operators.bloom import unseen
from shelfwise.operators.cleaning import clean_sales
from shelfwise.operators.rejects import LINE, facts_of, judged_feed, read_feed_lines, rejects_of
from shelfwise.schema import FACT_SCHEMA, ROW_KEYS, SERIES_KEYS, day_window
from shelfwise.sources.files import FEED_POSITION, read_if_exists, staged

MONTH, TAIL_ROWS = "sale_month", 7
FACTS, DAILY, WEEKLY, TOTALS = "clean_sales", "daily_store_aggregates", "weekly_category_stats", "product_months"
TOP, ALERTS, TAILS, REJECTS, NOTE = "top_products_by_store", "stock_alerts", "series_tails", "rejects", "unfinished"


@dataclass(frozen=True)
class Update:
    """What a feed brought: its lines, and where they went."""

    lines: int
    rejected: int
    copies: int
    seen_before: int
    added: int
    months: tuple[str, ...]
    alert_months: tuple[str, ...]


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored table with months and years as text, or ``None``; what an earlier plan knew of its files is dropped."""
    spark.catalog.refreshByPath(path)
    found = read_if_exists(spark, path)
    return found.withColumn(MONTH, F.col(MONTH).cast("string")) if found is not None and MONTH in found.columns else found


def replace_parts(df: DataFrame, path: str, column: str, values: Sequence[str] = ()) -> str:
    """Write ``df`` over the parts of a table that it has rows of; other parts stay.

    Of ``values``, for a table whose parts can come to have no rows, those without rows go.
    ``df`` must not read the table itself.
    """
    spark = df.sparkSession
    left = {str(row[0]) for row in df.select(column).distinct().collect()} if values else set()
    out = df.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy(column).parquet(path)
    for value in set(values) - left:
        _delete(spark, f"{path}/{column}={value}")
    spark.catalog.refreshByPath(path)
    return path


def typed_facts(judged: DataFrame) -> DataFrame:
    """Facts of a judged feed in the types of the fact table, with their places."""
    facts = facts_of(judged)
    kinds = {f.name: f.dataType for f in FACT_SCHEMA if f.name not in (*ROW_KEYS, "units", "stock")}
    others = {name: F.col(name).try_cast(kind) for name, kind in kinds.items()}
    return facts.drop(LINE, "repairs").withColumns(others)


def _months_of(df: DataFrame) -> list[str]:
    return sorted(row[0] for row in df.select(MONTH).distinct().collect())


def _tail_rows(spark: SparkSession, out: str, before: str) -> DataFrame | None:
    """The last rows of each series before a month, from the months' tails."""
    tails = _stored(spark, f"{out}/{TAILS}")
    if tails is None:
        return None
    newest = tails.where(F.col(MONTH) < before).groupBy(*SERIES_KEYS).agg(F.max_by("tail", MONTH).alias("tail"))
    rows = newest.select(*SERIES_KEYS, F.explode("tail").alias("row"))
    return rows.select(*SERIES_KEYS, "row.sale_date", "row.units")


def _alert_rows(spark: SparkSession, out: str, months: list[str], changed: DataFrame, alert_ratio: float) -> DataFrame:
    """Alerts, tails and whether a changed month has a say, of every row from the first touched month on."""
    columns = [*ROW_KEYS, "units", "stock", MONTH]
    rows = _stored(spark, f"{out}/{FACTS}").where(F.col(MONTH) >= months[0]).select(*columns)
    earlier = _tail_rows(spark, out, months[0])
    if earlier is not None:
        filled = earlier.withColumns({"stock": F.lit(None).cast(rows.schema["stock"].dataType), MONTH: F.lit(None).cast("string")})
        rows = rows.unionByName(filled.select(*columns))
    marked = rows.join(changed.withColumn("touched", F.lit(True)), [*SERIES_KEYS, MONTH], "left")
    back = day_window().rowsBetween(-TAIL_ROWS, 0)
    tail = F.collect_list(F.struct("sale_date", "units")).over(day_window().rowsBetween(1 - TAIL_ROWS, 0))
    judged = batch.stock_alerts(marked, alert_ratio, TAIL_ROWS).withColumns({"tail": tail, "changed": F.coalesce(F.max("touched").over(back), F.lit(False))})
    return judged.where(F.col(MONTH).isNotNull()).drop("touched")


def _write_alerts(spark: SparkSession, out: str, months: list[str], changed: DataFrame, alert_ratio: float) -> list[str]:
    rows = staged(_alert_rows(spark, out, months, changed, alert_ratio), "alert-rows")
    affected = sorted({row[0] for row in rows.where("changed").select(MONTH).distinct().collect()})
    own = rows.where(F.col(MONTH).isin(affected))
    report = batch.stock_alerts_report(own, ordered=False).withColumn(MONTH, F.date_format("sale_date", "yyyy-MM"))
    replace_parts(report, f"{out}/{ALERTS}", MONTH, affected)
    tails = own.groupBy(*SERIES_KEYS, MONTH).agg(F.max_by("tail", "sale_date").alias("tail"))
    replace_parts(tails, f"{out}/{TAILS}", MONTH)
    return affected


def _write_reports(spark: SparkSession, out: str, months: list[str], changed: DataFrame, top_n: int, alert_ratio: float) -> list[str]:
    facts = _stored(spark, f"{out}/{FACTS}")
    own = facts.where(F.col(MONTH).isin(months))
    daily = batch.daily_store_aggregates(own, cleaned=True).withColumn(MONTH, F.date_format("sale_date", "yyyy-MM"))
    replace_parts(daily, f"{out}/{DAILY}", MONTH)
    totals = own.groupBy(MONTH, "store", "product", "category").agg(F.sum("units").alias("units"))
    replace_parts(totals, f"{out}/{TOTALS}", MONTH)
    top = batch.top_products_by_store(_stored(spark, f"{out}/{TOTALS}"), top_n)
    top.write.mode("overwrite").parquet(f"{out}/{TOP}")
    years = sorted({month[:4] for month in months})
    whole = facts.where(F.substring(MONTH, 1, 4).isin(years) & F.col(MONTH).between(f"{years[0]}-01", f"{years[-1]}-12"))
    replace_parts(batch.weekly_category_stats(whole), f"{out}/{WEEKLY}", "year")
    return _write_alerts(spark, out, months, changed, alert_ratio)


def update_batch(spark: SparkSession, feed: str, out: str, top_n: int = 5, alert_ratio: float = 0.3) -> Update:
    """Add a CSV feed to the tables under ``out`` and bring their reports up to date.

    Of copies of a key in the feed the first line counts; a key that an earlier feed brought stays as
    it was. Lines whose key cannot be read are added to the rejects, also of a feed that is given twice.
    """
    judged = staged(judged_feed(read_feed_lines(spark, feed)), "judged")
    rejected = rejects_of(judged)
    rejected.write.mode("append").parquet(f"{out}/{REJECTS}")
    facts = typed_facts(judged)
    cleaned = clean_sales(facts, FEED_POSITION).drop(*FEED_POSITION).withColumn(MONTH, F.date_format("sale_date", "yyyy-MM"))
    cleaned = staged(cleaned, "cleaned")

    stored = _stored(spark, f"{out}/{FACTS}")
    new = cleaned
    if stored is not None:
        same_months = stored.where(F.col(MONTH).isin(_months_of(cleaned)))
        new = staged(unseen(cleaned, same_months, ROW_KEYS, same_months.count()), "new")
    months = _months_of(new)
    unfinished = read_if_exists(spark, f"{out}/{NOTE}")
    due = sorted({*months, *([row[0] for row in unfinished.collect()] if unfinished is not None else [])})

    lines, n_facts, n_clean, n_new = judged.count(), facts.count(), cleaned.count(), new.count()
    affected: list[str] = []
    if due:
        spark.createDataFrame([(m,) for m in due], f"{MONTH} string").coalesce(1).write.mode("overwrite").parquet(f"{out}/{NOTE}")
        if months:
            merged = new if stored is None else stored.where(F.col(MONTH).isin(months)).unionByName(new)
            replace_parts(staged(merged, "merged"), f"{out}/{FACTS}", MONTH)
        # Months noted by a run that ended before it had written any facts have no rows yet.
        rows = _stored(spark, f"{out}/{FACTS}").where(F.col(MONTH).isin(due))
        known = _months_of(rows)
        if known:
            # Of what an unfinished run added nothing is known but the months.
            changed = (new if unfinished is None else rows).select(*SERIES_KEYS, MONTH).distinct()
            affected = _write_reports(spark, out, known, changed, top_n, alert_ratio)
        _delete(spark, f"{out}/{NOTE}")
    return Update(lines, lines - n_facts, n_facts - n_clean, n_clean - n_new, n_new, tuple(months), tuple(affected))
