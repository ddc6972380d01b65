"""CSV and parquet sources and sinks, and the shared folder for staged tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.columns import to_day
from shelfwise.schema import FACT_SCHEMA, FEED_COLUMNS


# The most buckets Spark accepts by default.
MAX_BUCKETS = 100_000

# Where a row stands in the feed: its file, the split's offset and the order within the split.
FEED_POSITION = ["feed_file", "feed_block", "feed_row"]


def read_sales_csv(
    spark: SparkSession, path: str, raw: bool = False, positions: bool = False
) -> DataFrame:
    """The sales feed under the fact's column names.

    Headers are checked against the declared schema, so swapped columns fail
    instead of loading into the wrong place. With ``raw`` the date and the two
    measures stay text for ``clean_sales`` to coerce; otherwise text that is no date
    or number is null. ``positions`` adds ``FEED_POSITION``, by which the first of
    several copies can be told whatever order Spark reads files and splits in. A missing path
    raises Spark's own ``PATH_NOT_FOUND``.
    """
    as_text = {"sale_date", "units", "stock"} if raw else {"sale_date"}
    declared = T.StructType(
        [
            T.StructField(header, T.StringType() if name in as_text else FACT_SCHEMA[name].dataType)
            for header, name in FEED_COLUMNS.items()
        ]
    )
    rows = (
        spark.read.schema(declared)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
        .withColumnsRenamed(FEED_COLUMNS)
    )
    if positions:
        rows = rows.select(
            "*",
            F.col("_metadata.file_path").alias("feed_file"),
            F.col("_metadata.file_block_start").alias("feed_block"),
            F.monotonically_increasing_id().alias("feed_row"),
        )
    return rows if raw else rows.withColumn("sale_date", to_day(F.col("sale_date"), T.StringType()))


def write_sales_csv(df: DataFrame, path: str) -> str:
    """Write a fact as the CSV feed and return its path."""
    headers = {name: header for header, name in FEED_COLUMNS.items()}
    feed = df.select(*headers).withColumnsRenamed(headers)
    feed.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_table(
    df: DataFrame, path: str, month_of: str | None = None, fmt: str = "parquet"
) -> str:
    """Write a result and return its path.

    With ``month_of`` (a date column) the table is partitioned by month for
    later pruning. The rebalance hint lets Spark join small outputs and split a
    month that holds most of the rows, so no single task writes a hot month.
    """
    if month_of is None:
        df.write.mode("overwrite").format(fmt).option("header", True).save(path)
        return path
    out = df.withColumn("sale_month", F.date_format(month_of, "yyyy-MM"))
    (
        out.hint("rebalance", "sale_month")
        .write.mode("overwrite")
        .partitionBy("sale_month")
        .format(fmt)
        .option("header", True)
        .save(path)
    )
    return path


def read_if_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """A stored result, or ``None`` where nothing has been written yet."""
    try:
        return spark.read.format(fmt).option("header", True).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def folder_state(spark: SparkSession, folder: str) -> int:
    """A number that changes when files of a folder, or of its tables' folders, are written again."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for entry in system.listStatus(place):
        inside = system.listStatus(entry.getPath()) if entry.isDirectory() else [entry]
        found += [(f.getPath().toString(), f.getModificationTime(), f.getLen()) for f in inside]
    return hash(tuple(sorted(found)))


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files below a folder; 0 where there is nothing."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.getContentSummary(place).getLength() if system.exists(place) else 0


def shared_dir(spark: SparkSession) -> str:
    """A folder every executor can reach: the checkpoint folder, else the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    already_set = spark.sparkContext.getCheckpointDir()
    if already_set:
        return already_set.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    if not warehouse:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return warehouse.rstrip("/")


# The folders each application has staged tables in.
_STAGED: dict[str, list[str]] = {}


def _stage_prefix(spark: SparkSession) -> str:
    return "shelfwise_stage_" + spark.sparkContext.applicationId.replace("-", "_").lower()


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, which ``forget_staged`` deletes."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def staged(df: DataFrame, name: str, by: Sequence[str] = (), order: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For a table that several jobs read (an iterative fit, several models): it is
    computed once, in columnar form, and a lost executor cannot lose it. With
    ``by`` it is bucketed by those columns as a shuffle on them would place its
    rows, so later windows and aggregates per ``by`` read it without a shuffle.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    if not by:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_BUCKETS)
    entry = f"{_stage_prefix(spark)}_{uuid.uuid4().hex}"
    placed = df.repartition(buckets, *by)  # a task writes whole buckets: no more files than buckets
    writer = placed.write.format("parquet").option("path", path)
    writer.bucketBy(buckets, *by).sortBy(*by, *order).saveAsTable(entry)
    return spark.table(entry)


def forget_staged(spark: SparkSession) -> None:
    """Drop this application's stages: their entries in the catalog and their files."""
    for entry in spark.catalog.listTables(pattern=f"{_stage_prefix(spark)}*"):
        spark.sql(f"drop table if exists {entry.name}")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in _STAGED.pop(spark.sparkContext.applicationId, []):
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
