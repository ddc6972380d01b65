"""One key with a third of all rows: same results, and no task gets the whole group."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import batch, cleaning, overview
from shelfwise.sources import files, star

ROWS = 120_000


@pytest.fixture
def tight(spark):
    """No broadcast joins, and thresholds low enough for small data to count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key in settings:
        spark.conf.unset(key)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.fixture(scope="module")
def hot_lines(spark):
    """Lines of which a third belongs to one series and day."""
    hot = F.col("id") % 3 == 0
    spread = F.col("id")
    return spark.range(0, ROWS, 1, 8).select(
        F.when(hot, F.lit("2022-01-05").cast("date"))
        .otherwise(F.date_add(F.lit("2022-01-01").cast("date"), (spread % 30).cast("int")))
        .alias("sale_date"),
        F.when(hot, "S0").otherwise(F.concat(F.lit("S"), spread % 7)).alias("store"),
        F.when(hot, "P0").otherwise(F.concat(F.lit("P"), spread % 11)).alias("product"),
        F.lit("c").alias("category"),
        (spread % 50).cast("double").alias("units"),
        (spread % 13).cast("int").alias("stock"),
        F.col("id").alias("seq"),
    )


def test_a_hot_key_of_copies_is_cleaned_to_its_first_row(hot_lines):
    cleaned = cleaning.clean_sales(hot_lines, ["seq"])
    row = cleaned.where("store = 'S0' and product = 'P0' and sale_date = '2022-01-05'").collect()
    assert [r.seq for r in row] == [0]
    counted = cleaning.duplicate_count(hot_lines).collect()[0]
    assert counted.rows_before == ROWS and counted.rows_after == cleaned.count()


def test_a_hot_supplier_is_split_by_the_star_join(tight, tmp_path):
    spark, folder = tight, str(tmp_path)
    (
        spark.range(0, ROWS, 1, 8)
        .select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("long").alias("l_suppkey"),
            (F.hash("id") % 300 + 300).cast("long").alias("l_partkey"),
            (F.col("id") % 50).cast("double").alias("l_quantity"),
            F.date_add(F.lit("2022-01-01").cast("date"), (F.col("id") % 90).cast("int"))
            .cast("timestamp_ntz")
            .alias("l_shipdate"),
        )
        .write.parquet(f"{folder}/lineitem.parquet")
    )
    spark.range(500).selectExpr("id as s_suppkey", "cast(id % 25 as int) as s_nationkey").write.parquet(
        f"{folder}/supplier.parquet"
    )
    spark.range(25).selectExpr("cast(id as int) as n_nationkey", "cast(id % 5 as int) as n_regionkey").write.parquet(
        f"{folder}/nation.parquet"
    )
    spark.range(5).selectExpr("cast(id as int) as r_regionkey", "concat('R', id) as r_name").write.parquet(
        f"{folder}/region.parquet"
    )
    spark.range(600).selectExpr("id as p_partkey", "concat('T', id % 6) as p_type", "1 as p_size").write.parquet(
        f"{folder}/part.parquet"
    )
    lines = star.sales_lines(spark, folder)
    assert "SortMergeJoin(skew=true)" in final_plan(lines)
    daily = star.sales_daily(spark, folder)
    totals = daily.agg(F.sum("units"), F.sum("stock")).collect()[0]
    assert tuple(totals) == (sum(i % 50 for i in range(ROWS)), ROWS)


def test_a_hot_day_is_split_when_means_join_back_to_lines(tight, hot_lines):
    out = batch.rolling_mean_range_lines(hot_lines.select("sale_date", "store", "product", "units", "seq"))
    assert "skew=true" in final_plan(out)
    assert out.count() == ROWS
    window = batch.rolling_mean_range(hot_lines).select("seq", F.round("rolling_mean_7d", 9).alias("expected"))
    both = out.join(window, "seq").where(F.round("rolling_mean_7d", 9) != F.col("expected"))
    assert both.count() == 0


def test_totals_over_a_hot_store(hot_lines):
    kpis = {r.store: r.units_total for r in overview.store_kpis(hot_lines).collect()}
    assert sum(kpis.values()) == sum(i % 50 for i in range(ROWS))
    profile = overview.dataset_profile(hot_lines).collect()[0]
    assert (profile["rows"], profile.stores, profile.products) == (ROWS, 7, 11)
    daily = batch.daily_store_aggregates(hot_lines.withColumn("is_holiday", F.lit(0)))
    assert daily.agg(F.sum("units_total")).collect()[0][0] == sum(i % 50 for i in range(ROWS))


def test_a_store_with_most_products_still_ranks_all_of_them(spark):
    df = spark.range(0, ROWS, 1, 8).selectExpr(
        "case when id % 3 = 0 then 'hot' else concat('S', id % 50) end as store", "id as product", "'c' as category",
        "cast(id as double) as units",
    )
    hot = batch.top_products_by_store(df).where("store = 'hot'").collect()
    assert [r["product"] for r in hot] == [i for i in range(ROWS - 1, 0, -1) if i % 3 == 0][:5]


def test_a_hot_month_is_written_by_several_tasks(tight, hot_lines, tmp_path):
    path = tmp_path / "out"
    files.write_table(hot_lines.withColumn("id", F.xxhash64("seq")), str(path), month_of="sale_date")
    assert len(list((path / "sale_month=2022-01").glob("*.parquet"))) > 1
    assert tight.read.parquet(str(path)).count() == ROWS
