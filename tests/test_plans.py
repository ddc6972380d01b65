"""The shape of the physical plans: what is shuffled, pruned and pushed down."""

import contextlib
import datetime as dt
import io
import re

import pytest
from pyspark.sql import functions as F

from shelfwise.forecasting.holt_winters import holt_winters_forecast
from shelfwise.forecasting.moving_average import moving_average_forecast
from shelfwise.operators import batch, cleaning, overview
from shelfwise.operators import features as ft
from shelfwise.sources.files import forget_staged, staged, write_table
from shelfwise.plans.batch import cleaned_feed


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("simple")
    return text.getvalue()


def shuffles(df):
    return re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", plan(df))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A stored fact, as the jobs read it: no partitioning known beforehand."""
    start = dt.date(2022, 1, 1)
    rows = [
        (start + dt.timedelta(days=i), s, p, "c", float(i % 9), i % 11, 0)
        for s in "AB" for p in "xyz" for i in range(90)
    ]
    path = str(tmp_path_factory.mktemp("fact") / "sales")
    spark.createDataFrame(
        rows, "sale_date date, store string, product string, category string, units double, stock int, is_holiday int"
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_one_shuffle_fills_gaps_and_builds_all_features(stored, holidays):
    rows = ft.min_max_scaled(ft.temporal_split(cleaning.dense_series(stored)))
    assert shuffles(ft.add_history_features(rows)) == ["hashpartitioning"]
    matrix = plan(ft.feature_matrix(cleaning.dense_series(stored), holidays))
    assert len(re.findall(r"Exchange hashpartitioning\(store", matrix)) == 1


def test_forecasts_reuse_the_series_shuffle(stored):
    dense = cleaning.dense_series(stored)
    assert shuffles(moving_average_forecast(dense)) == ["hashpartitioning"]
    assert shuffles(holt_winters_forecast(dense, [(0.1, 0.01, 0.1)])) == ["hashpartitioning"]


def test_series_staged_by_key_need_no_further_shuffle(spark, stored):
    scaled = ft.min_max_scaled(ft.temporal_split(cleaning.dense_series(stored)))
    rows = staged(scaled, "series", ["store", "product"], ["sale_date"])
    assert sorted(rows.columns) == sorted(scaled.columns) and rows.count() == scaled.count()
    series = rows.select("store", "product", "sale_date", "units")
    for df in (
        moving_average_forecast(series),
        holt_winters_forecast(series),
        ft.validation_split(ft.lookback_sequences(rows, 10)),
    ):
        assert shuffles(df) == []
    forget_staged(spark)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("shelfwise_stage")]


def test_duplicates_are_reduced_before_the_shuffle(stored):
    text = plan(cleaning.clean_sales(stored))
    assert text.index("Exchange hashpartitioning") < text.index("partial_min")
    assert "Window" not in text
    assert shuffles(cleaning.clean_sales(stored)) == ["hashpartitioning"]


def test_ranking_limits_each_store_before_the_shuffle(stored):
    text = plan(batch.top_products_by_store(stored))
    assert re.search(r"WindowGroupLimit .* Final", text) and re.search(r"WindowGroupLimit .* Partial", text)


def test_cleaned_daily_aggregates_shuffle_partial_sums_only(stored):
    rows = batch.daily_store_aggregates(stored, cleaned=True)
    assert shuffles(rows) == ["rangepartitioning", "hashpartitioning"]
    assert "partial_count" in plan(rows)
    assert "product" not in re.search(r"Exchange hashpartitioning\(([^)]*)\)", plan(rows)).group(1)


def test_profile_counts_distinct_after_one_aggregate_per_series(stored):
    text = plan(overview.dataset_profile(stored))
    assert text.index("Expand") < text.rindex("Exchange hashpartitioning(store")


def test_latest_alerts_is_a_top_k_without_a_full_sort(stored):
    text = plan(batch.latest_alerts(batch.stock_alerts(stored)))
    assert "TakeOrderedAndProject(limit=100" in text and "rangepartitioning" not in text


def test_series_filter_reaches_the_scan_below_the_windows(stored):
    one = stored.where((F.col("store") == "A") & (F.col("product") == "x"))
    text = plan(cleaning.dense_series(one))
    assert "EqualTo(store,A)" in text and "EqualTo(product,x)" in text
    late = plan(cleaning.dense_series(stored).where(F.col("store") == "A"))
    assert "EqualTo(store,A)" in late


def test_only_needed_columns_are_read(stored):
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(cleaning.dense_series(stored))).group(1)
    assert {part.split(":")[0] for part in schema.split(",")} == {"sale_date", "store", "product", "units"}


def test_features_from_a_date_push_the_reach_to_the_scan(stored, holidays):
    text = plan(ft.feature_matrix(stored.select("store", "product", "sale_date", "units"), holidays, dt.date(2022, 2, 15)))
    assert "GreaterThanOrEqual(sale_date,2022-01-16)" in text


def test_features_from_a_date_read_only_their_months(spark, stored, holidays, tmp_path):
    path = write_table(cleaning.dense_series(stored), str(tmp_path / "dense"), month_of="sale_date")
    dense = spark.read.parquet(path)
    rows = ft.feature_matrix(dense, holidays, dt.date(2022, 3, 5))
    assert "(sale_month" in plan(rows) and ">= 2022-02)" in plan(rows)
    whole = ft.feature_matrix(dense, holidays).where("sale_date >= '2022-03-05'")
    assert sorted(rows.collect()) == sorted(whole.collect()) and rows.count() > 0


def test_no_operator_runs_python_but_the_grid_search(stored, holidays):
    dense = cleaning.dense_series(stored)
    outputs = [
        cleaning.clean_sales(stored), dense, ft.feature_matrix(dense, holidays), batch.stock_alerts(stored),
        batch.weekly_category_stats(stored), holt_winters_forecast(dense, [(0.1, 0.01, 0.1)]),
        ft.lookback_sequences(ft.min_max_scaled(ft.temporal_split(dense))),
    ]
    assert not any("Python" in plan(df) or "InPandas" in plan(df) for df in outputs)
    assert "ArrowEvalPython" in plan(holt_winters_forecast(dense))


def test_nothing_forces_a_broadcast(stored, holidays, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(ft.feature_matrix(cleaning.dense_series(stored), holidays))
        assert "Broadcast" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_feed_reader_is_lazy(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    assert cleaned_feed(spark, str(tmp_path / "feed")).columns[0] == "sale_date"


def test_recent_features_read_the_sales_once(spark, tmp_path, sales, holidays):
    days = [dt.date(2022, 1, 1) + dt.timedelta(days=i) for i in range(0, 150, 3)]
    path = write_table(sales([("S", p, d.isoformat(), 3 + d.day, 4) for p in "ab" for d in days]), str(tmp_path / "daily"))
    stored, since = spark.read.parquet(path), dt.date(2022, 5, 1)
    recent = ft.feature_matrix(cleaning.dense_series(stored, ft.reach_before(since)), holidays, since)
    text = plan(recent)
    assert text.count("FileScan parquet") == 1 and text.count("hashpartitioning(store") == 1
    whole = ft.feature_matrix(cleaning.dense_series(stored), holidays).where("sale_date >= '2022-05-01'")
    order = ["product", "sale_date"]
    assert recent.orderBy(*order).collect() == whole.orderBy(*order).collect() and recent.count() > 0
