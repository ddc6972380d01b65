import datetime as dt

import pytest

from shelfwise.forecasting.trees import load_model
from shelfwise.operators.cleaning import clean_sales
from shelfwise.plans.batch import run_batch, stored_row_counts
from shelfwise.plans.run import main
from shelfwise.plans.settings import session_settings
from shelfwise.plans.training import run_training, train_all
from shelfwise.schema import FEED_COLUMNS, REPORT_COLUMNS

WEEK = [12, 5, 7, 9, 20, 30, 15]
QUICK = {"num_trees": 3, "max_depth": 4, "max_iter": 10, "lookback": 7, "grid": [(0.1, 0.01, 0.1), (0.2, 0.0, 0.1)]}


def sale(store, product, i):
    day = dt.date(2022, 1, 1) + dt.timedelta(days=i)
    units = WEEK[i % 7] * (1 + len(product) % 3) + i * 7919 % 4
    return day, store, product, "Hogar", float(units), i * 31 % 40


@pytest.fixture(scope="module")
def feed(tmp_path_factory):
    path = tmp_path_factory.mktemp("feed") / "feed.csv"
    rows = [sale(s, p, i) for s in ("A", "B") for p in ("x", "yy") for i in range(90)]
    lines = [",".join(FEED_COLUMNS)]
    for day, store, product, category, units, stock in rows:
        lines.append(f"{day},{store},{product},{category},{units},{stock},0,{day.weekday()},{day.month},1,1")
    lines.append(lines[1].replace(",12.0,", ",1.0,"))  # a later, smaller copy of the first key
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_batch_job_writes_all_reports(spark, feed, tmp_path):
    result = run_batch(spark, feed, str(tmp_path))
    counts = {r.output: r["rows"] for r in stored_row_counts(spark, result.paths).collect()}
    assert counts["clean_sales"] == 360 and counts["daily_store_aggregates"] == 180
    assert counts["top_products_by_store"] == 4 and counts["weekly_category_stats"] == 14
    alerts = spark.read.parquet(result.paths["stock_alerts"])
    assert {r.state for r in alerts.select("state").distinct().collect()} <= {"CRITICO", "BAJO"}
    assert alerts.where("state = 'CRITICO'").count() == result.critical_alerts > 0
    days = spark.read.parquet(result.paths["clean_sales"])
    assert days.where("sale_month = '2022-02'").count() == 28 * 4
    first = days.where("sale_date = '2022-01-01' and store = 'A' and product = 'x'").collect()
    assert [r.units for r in first] == [24.0]


def test_batch_job_can_write_csv_with_the_expected_headers(spark, feed, tmp_path):
    result = run_batch(spark, feed, str(tmp_path), report_format="csv", report_names=True)
    for name, headers in REPORT_COLUMNS.items():
        written = spark.read.option("header", True).csv(result.paths[name])
        assert written.columns == list(headers.values()), name
    assert result.critical_alerts == run_batch(spark, feed, str(tmp_path / "again")).critical_alerts


def test_batch_job_reads_tables_too(spark, feed, tmp_path):
    from shelfwise.sources.files import read_sales_csv, write_table

    stored = write_table(read_sales_csv(spark, feed, raw=True), str(tmp_path / "raw"))
    from_table = run_batch(spark, stored, str(tmp_path / "a"), feed_format="parquet")
    assert from_table.critical_alerts == run_batch(spark, feed, str(tmp_path / "b")).critical_alerts


@pytest.fixture
def cleaned(spark, sales):
    rows = [sale(s, p, i) for s in ("A", "B") for p in ("x", "yy") for i in range(90)]
    return clean_sales(sales([(s, p, d.isoformat(), u, k) for d, s, p, _, u, k in rows]))


def test_training_job_scores_every_series(spark, cleaned, holidays, tmp_path):
    comparison = run_training(cleaned, holidays, str(tmp_path), **QUICK).collect()
    models = {"moving_average_7d", "holt_winters", "random_forest", "lookback"}
    assert {(r.store, r["product"], r.model) for r in comparison} == {
        (s, p, m) for s in "AB" for p in ("x", "yy") for m in models
    }
    assert {r.days for r in comparison} == {18}
    for key in {(r.store, r["product"]) for r in comparison}:
        mine = sorted((r["rank"], r.mape, r.model) for r in comparison if (r.store, r["product"]) == key)
        assert [rank for rank, _, _ in mine] == [1, 2, 3, 4]
        assert [(m, n) for _, m, n in mine] == sorted((m, n) for _, m, n in mine)
    runs = spark.read.parquet(str(tmp_path / "runs"))
    assert runs.count() == 4 * 4 * 3 and runs.select("run_id").distinct().count() == 1
    params = runs.collect()[0].params
    assert params["num_trees"] == "3" and (params["train_days"], params["test_days"]) == ("72", "18")
    assert {(r.params["store"] + "_" + r.params["product"]) for r in runs.collect()} == {
        r.run_name for r in runs.collect()
    }
    assert spark.read.parquet(str(tmp_path / "best_model")).count() == 4
    assert spark.read.parquet(str(tmp_path / "feature_importance")).count() == 23
    assert spark.read.parquet(str(tmp_path / "lookback_history")).count() > 1
    curves = spark.read.parquet(str(tmp_path / "curves"))
    assert {r.curve for r in curves.select("curve").distinct().collect()} == models | {"actual"}
    assert load_model(str(tmp_path / "random_forest")).stages[-1].getNumTrees == 3


def test_training_one_series_appends_to_the_runs(spark, cleaned, holidays, tmp_path):
    for product in ("x", "yy"):
        comparison = run_training(cleaned, holidays, str(tmp_path), "A", product, **QUICK)
        assert {r["product"] for r in comparison.collect()} == {product}
    runs = spark.read.parquet(str(tmp_path / "runs"))
    assert {r.run_name for r in runs.collect()} == {"A_x", "A_yy"}
    with pytest.raises(ValueError):
        run_training(cleaned, holidays, str(tmp_path), "A", "absent", **QUICK)


def test_feature_rows_may_be_split_by_themselves(spark, series, holidays):
    df = series({"P": [WEEK[i % 7] for i in range(130)]})
    common = train_all(df, holidays, **QUICK)
    own = train_all(df, holidays, own_feature_split=True, **QUICK)

    def forest_days(training):
        return training.forecasts.where("model = 'random_forest'").count()

    assert forest_days(common) == 26  # the last fifth of 130 days
    assert forest_days(own) == 20  # the last fifth of 100 feature rows
    days = {r.model: r.days for r in own.comparison().collect()}
    assert set(days.values()) == {20}
    apart = {r.model: r.days for r in own.comparison(common_dates=False).collect()}
    assert apart["random_forest"] == 20 and apart["holt_winters"] == 26


def test_short_series_keep_their_simple_forecasts(spark, series, holidays):
    df = series({"long": [WEEK[i % 7] for i in range(120)], "short": [WEEK[i % 7] for i in range(20)]})
    out = train_all(df, holidays, **QUICK).forecasts.collect()
    models = {r.model for r in out if r["product"] == "short"}
    assert {"moving_average_7d", "holt_winters"} <= models and "random_forest" not in models


def test_command_line_runs_both_jobs(spark, feed, tmp_path, capsys):
    main(["batch", "--feed", feed, "--out", str(tmp_path)])
    assert "critical alerts:" in capsys.readouterr().out
    options = ["--trees", "2", "--depth", "3", "--lookback", "7"]
    main(["train", "--sales", str(tmp_path / "clean_sales"), "--out", str(tmp_path), "--store", "A", "--product", "x", *options])
    assert "series_won" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "model_comparison")).count() == 4


def test_settings_follow_the_shuffle_size():
    small, large = session_settings(10**9, 64), session_settings(100 * 10**12, 8000)
    assert small["spark.sql.shuffle.partitions"] == "64"
    assert large["spark.sql.shuffle.partitions"] == "40000"
    assert int(large["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) == 100 * 10**12 // 40_000
    assert large["spark.sql.files.maxPartitionBytes"] == str(1024**3)
