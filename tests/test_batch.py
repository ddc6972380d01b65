import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import batch, overview
from shelfwise.operators.features import with_holiday_flag


def days(n, first="2022-01-01"):
    start = dt.date.fromisoformat(first)
    return [(start + dt.timedelta(days=i)).isoformat() for i in range(n)]


def test_daily_store_aggregates(sales, holidays):
    df = sales([
        ("S", "P", "2022-01-06", 4, 10), ("S", "Q", "2022-01-06", 8, 5), ("T", "P", "2022-01-07", 1, 1),
    ])
    df = with_holiday_flag(df, holidays)
    out = batch.daily_store_aggregates(df).collect()
    assert [tuple(r) for r in out] == [
        (dt.date(2022, 1, 6), "S", 12.0, 2, 6.0, 15, 1),
        (dt.date(2022, 1, 7), "T", 1.0, 1, 1.0, 1, 0),
    ]
    assert batch.daily_store_aggregates(df, cleaned=True).collect() == out


def test_repeated_products_count_once_per_day_and_store(sales, holidays):
    df = with_holiday_flag(sales([("S", "P", "2022-01-01", 1, 1)] * 3), holidays)
    assert batch.daily_store_aggregates(df).collect()[0].distinct_products == 1


def test_calendar_year_pairs_with_iso_week_unless_iso_years_are_asked_for(sales):
    df = sales([("S", "P", d, 1, 1) for d in ("2022-01-01", "2022-12-31", "2023-01-01", "2024-12-30")])
    default = {(r.year, r.week): r.row_count for r in batch.weekly_category_stats(df).collect()}
    assert default == {(2022, 52): 2, (2023, 52): 1, (2024, 1): 1}
    iso = {(r.year, r.week): r.row_count for r in batch.weekly_category_stats(df, iso_years=True).collect()}
    assert iso == {(2021, 52): 1, (2022, 52): 2, (2025, 1): 1}


def test_deviation_of_one_row_is_null(sales):
    out = batch.weekly_category_stats(sales([("S", "P", "2022-01-01", 3, 1)])).collect()[0]
    assert out.units_std is None and out.units_mean == 3.0


def test_ties_at_the_last_rank_all_stay(sales):
    rows = [("S", p, "2022-01-01", u, 1) for p, u in zip("abcdefg", (9, 8, 7, 6, 5, 5, 4))]
    out = batch.top_products_by_store(sales(rows)).collect()
    assert [(r.product, r["rank"]) for r in out] == [
        ("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5), ("f", 5),
    ]


def test_range_mean_holds_eight_days_unless_inclusive(sales):
    df = sales([("S", "P", d, i, 1) for i, d in enumerate(days(10))])
    out = {r.units: r.rolling_mean_7d for r in batch.rolling_mean_range(df).collect()}
    assert out[9.0] == sum(range(2, 10)) / 8
    inclusive = {r.units: r.rolling_mean_7d for r in batch.rolling_mean_range(df, inclusive_days=True).collect()}
    assert inclusive[9.0] == sum(range(3, 10)) / 7


def test_range_counts_days_across_gaps_and_clock_changes(spark, sales):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        df = sales([("S", "P", d, 1, 1) for d in days(24, "2022-10-20")])
        counted = df.withColumn("units", F.dayofyear("sale_date").cast("double"))
        out = sorted((r.units, r.rolling_mean_7d) for r in batch.rolling_mean_range(counted).collect())
        assert all(mean == unit - 3.5 for unit, mean in out[7:])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_range_mean_over_lines_equals_the_window_over_lines(sales):
    rows = [("S", "P", d, i % 5 + k, 1) for i, d in enumerate(days(20)[::3]) for k in range(i % 3 + 1)]
    df = sales(rows)
    expected = sorted(tuple(r) for r in batch.rolling_mean_range(df).select("sale_date", "units", "rolling_mean_7d").collect())
    lines = sorted(tuple(r) for r in batch.rolling_mean_range_lines(df).select("sale_date", "units", "rolling_mean_7d").collect())
    assert lines == expected


def test_alert_mean_uses_previous_rows_and_may_be_partial(sales):
    # a gap between the days: rows count, not days
    df = sales([("S", "P", d, 10, s) for d, s in zip(days(20)[::2], (0, 2, 3, 9, 10, 11, 0, 0, 0, 0))])
    out = batch.stock_alerts(df).orderBy("sale_date").collect()
    assert out[0].units_mean_prev7 is None and out[0].state == "OK"
    assert [r.state for r in out[1:7]] == ["CRITICO", "BAJO", "BAJO", "OK", "OK", "CRITICO"]
    rising = sales([("S", "P", d, i, 0) for i, d in enumerate(days(12))])
    last = batch.stock_alerts(rising).orderBy("sale_date").collect()[-1]
    assert last.units_mean_prev7 == sum(range(4, 11)) / 7


def test_alert_report_and_counts(sales):
    df = sales([(s, "P", d, 10, stock) for s in "AB" for d, stock in zip(days(6), (0, 0, 0, 5, 50, 50))])
    alerts = batch.stock_alerts(df)
    report = batch.stock_alerts_report(alerts).collect()
    assert [(r.sale_date.day, r.store, r.state) for r in report] == [
        (4, "A", "BAJO"), (4, "B", "BAJO"), (3, "A", "CRITICO"), (3, "B", "CRITICO"),
        (2, "A", "CRITICO"), (2, "B", "CRITICO"),
    ]
    counts = {r.state: r["rows"] for r in batch.alert_counts(alerts).collect()}
    assert counts == {"CRITICO": 4, "BAJO": 2, "OK": 6}
    assert sum(counts.values()) == df.count()
    assert [tuple(r) for r in batch.latest_alerts(alerts, 2).collect()] == [tuple(r) for r in report[:2]]


def test_alert_rows_are_a_parameter(sales):
    df = sales([("S", "P", d, i, 0) for i, d in enumerate(days(6))])
    report = batch.stock_alerts_report(batch.stock_alerts(df, rows=2)).collect()
    assert [r.units_mean_prev2 for r in report][:2] == [3.5, 2.5]


def test_alert_ratio_is_a_parameter(sales):
    df = sales([("S", "P", d, 10, 4) for d in days(3)])
    states = [r.state for r in batch.stock_alerts(df, alert_ratio=0.5).orderBy("sale_date").collect()]
    assert states == ["OK", "CRITICO", "CRITICO"]


def test_store_kpis(sales):
    df = sales([
        ("S", "P", "2022-01-01", 2, 10), ("S", "Q", "2022-01-01", 4, 20), ("S", "P", "2022-01-02", 9, 30),
    ])
    row = overview.store_kpis(df).collect()[0]
    assert tuple(row) == ("S", 15.0, 7.5, 2, 20.0)


def test_moving_average_of_daily_totals_needs_seven_days(sales):
    df = sales([("S", p, d, i, 1) for i, d in enumerate(days(9)) for p in "PQ"])
    out = overview.daily_total_moving_average(df).orderBy("sale_date").collect()
    assert [r.moving_average_7 for r in out] == [None] * 6 + [6.0, 8.0, 10.0]


def test_weekday_names_start_on_monday(sales):
    df = sales([("S", "P", d, i, 1) for i, d in enumerate(days(7, "2022-01-03"))])
    out = overview.dow_seasonality(df).orderBy("dow").collect()
    assert [(r.dow, r.day_name, r.units_mean) for r in out][0] == (0, "Lun", 0.0)
    assert out[6].day_name == "Dom"


def test_category_sales_largest_first(spark):
    df = spark.createDataFrame([("S", "a", 1.0), ("S", "b", 5.0), ("S", "a", 2.0)], "store string, category string, units double")
    assert [r.category for r in overview.category_sales(df).collect()] == ["b", "a"]


def test_profile_and_distinct_values(sales):
    df = sales([("S", "P", "2022-01-01", 2, 1), ("T", "P", "2022-01-05", 4, 1)])
    assert tuple(overview.dataset_profile(df).collect()[0]) == (
        2, 2, 1, dt.date(2022, 1, 1), dt.date(2022, 1, 5), 3.0,
    )
    assert [r.store for r in overview.distinct_values(df, "store").collect()] == ["S", "T"]
    empty = overview.dataset_profile(df.where("false")).collect()[0]
    assert empty["rows"] == 0 and empty.units_mean is None


@pytest.mark.parametrize("top_n", [1, 3])
def test_top_n_is_a_parameter(sales, top_n):
    rows = [(s, p, "2022-01-01", ord(p), 1) for s in "ST" for p in "abcdef"]
    assert batch.top_products_by_store(sales(rows), top_n).count() == 2 * top_n


def test_reports_accept_uncleaned_rows(spark, holidays):
    df = spark.createDataFrame(
        [("S", "P", "c", 4.0, 2), ("S", "P", "c", 4.0, 2), ("S", "Q", "c", None, None), ("S", None, None, 1.0, 1)],
        "store string, product string, category string, units double, stock int",
    ).withColumn("sale_date", F.lit("2022-01-06").cast("date"))
    row = batch.daily_store_aggregates(with_holiday_flag(df, holidays)).collect()[0]
    assert (row.units_total, row.distinct_products, row.units_mean, row.stock_total) == (9.0, 2, 3.0, 5)
    weeks = {r.category: (r.units_week, r.row_count) for r in batch.weekly_category_stats(df).collect()}
    assert weeks == {"c": (8.0, 3), None: (1.0, 1)}
    top = [(r["product"], r.total_units) for r in batch.top_products_by_store(df).collect()]
    assert top == [("P", 8.0), (None, 1.0), ("Q", None)]
