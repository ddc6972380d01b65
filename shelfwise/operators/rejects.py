"""A feed split into facts and rejected lines, in one pass, with reasons and places.

A line whose key cannot be read is rejected: a date that is missing or no date, a store
or product that is missing, or a line that does not fit the feed's columns. All other lines are
facts; a measure that is no number or below zero is repaired as cleaning does, and the
repair is named. So facts and rejects together are the lines read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.columns import non_negative, to_day
from shelfwise.schema import FEED_COLUMNS, ROW_KEYS
from shelfwise.sources.files import FEED_POSITION, write_table

FACT, REJECT = "fact", "reject"
MALFORMED, NO_DATE, BAD_DATE = "malformed line", "date missing", "date unreadable"
NO_STORE, NO_PRODUCT = "store missing", "product missing"
MEASURES = ["units", "stock"]
#: The text of a line that does not fit the declared columns.
LINE = "malformed"


def _missing(name: str) -> Column:
    return F.col(name).isNull() | (F.trim(F.col(name).cast("string")) == "")


def _number(name: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.NumericType):
        return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))
    return F.nanvl(F.col(name).try_cast("double"), F.lit(None).cast("double"))


def _reason(df: DataFrame) -> Column:
    """Why a line is rejected: the first reason that holds, or null."""
    day = to_day(F.col("sale_date"), df.schema["sale_date"].dataType)
    reason = F.when(F.col(LINE).isNotNull(), MALFORMED) if LINE in df.columns else F
    return (
        reason.when(_missing("sale_date"), NO_DATE)
        .when(day.isNull(), BAD_DATE)
        .when(_missing("store"), NO_STORE)
        .when(_missing("product"), NO_PRODUCT)
    )


def _repairs(df: DataFrame) -> Column:
    """What cleaning changes in a line's measures."""
    found = []
    for name in MEASURES:
        number = _number(name, df.schema[name].dataType)
        found.append(F.when(number.isNull(), f"{name} no number").when(number < 0, f"{name} below zero"))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def judged_feed(feed: DataFrame) -> DataFrame:
    """Every line of a raw feed with its ``verdict``, the ``reason`` of a reject and the ``repairs`` of a fact.

    The other columns stay as read. A column ``malformed`` holds the text of lines that do
    not fit the feed's columns, where the reader kept it.
    """
    judged = feed.withColumn("reason", _reason(feed))
    fact = F.col("reason").isNull()
    return judged.withColumns(
        {"verdict": F.when(fact, FACT).otherwise(REJECT), "repairs": F.when(fact, _repairs(feed)).otherwise(F.array().cast("array<string>"))}
    )


def facts_of(judged: DataFrame) -> DataFrame:
    """The facts of a judged feed, with dates and repaired measures; copies of a key are still there."""
    rows = judged.where(F.col("verdict") == FACT).drop("verdict", "reason", LINE)
    measures = {name: non_negative(F.col(name), rows.schema[name].dataType) for name in MEASURES}
    return rows.withColumns({"sale_date": to_day(F.col("sale_date"), rows.schema["sale_date"].dataType), **measures})


def rejects_of(judged: DataFrame, place: Sequence[str] = FEED_POSITION) -> DataFrame:
    """The rejected lines: key as read, reason and place."""
    line = [LINE] if LINE in judged.columns else []
    return judged.where(F.col("verdict") == REJECT).select(*[F.col(c).cast("string").alias(c) for c in ROW_KEYS], "reason", *line, *place)


def feed_counts(judged: DataFrame) -> DataFrame:
    """(verdict, reason, rows): lines by verdict, rejects by reason and facts by repair; a fact may have two.

    Rows with a null reason are the totals of both verdicts; their sum is the lines read.
    """
    totals = judged.groupBy("verdict").agg(F.count(F.lit(1)).alias("rows")).select("verdict", F.lit(None).cast("string").alias("reason"), "rows")
    why = F.explode(F.when(F.col("verdict") == REJECT, F.array("reason")).otherwise(F.col("repairs")))
    by_reason = judged.select("verdict", why.alias("reason")).groupBy("verdict", "reason").agg(F.count(F.lit(1)).alias("rows"))
    return totals.unionByName(by_reason)


def read_feed_lines(spark: SparkSession, path: str) -> DataFrame:
    """A CSV feed as text under the fact's names, with places and the text of malformed lines."""
    declared = T.StructType([T.StructField(header, T.StringType()) for header in FEED_COLUMNS])
    lines = (
        spark.read.schema(declared.add(LINE, T.StringType()))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnPruning", False)  # whether a line is malformed depends on all its columns
        .option("columnNameOfCorruptRecord", LINE)
        .csv(path)
        .withColumnsRenamed(FEED_COLUMNS)
    )
    return lines.select(
        "*",
        F.col("_metadata.file_path").alias("feed_file"),
        F.col("_metadata.file_block_start").alias("feed_block"),
        F.monotonically_increasing_id().alias("feed_row"),
    )


def write_judged(judged: DataFrame, path: str) -> str:
    """Write facts and rejects side by side in one pass over the feed, in a folder each; returns the path."""
    judged.write.mode("overwrite").partitionBy("verdict").parquet(path)
    return path


def write_rejects(judged: DataFrame, path: str) -> str:
    return write_table(rejects_of(judged), path)
