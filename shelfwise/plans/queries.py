"""Every operator as a named query over the star-schema tables.

Queries read whole tables and stay lazy, except those that fit a model. Values
that come from floating-point sums are rounded to 6 decimals, so that engines
that add in another order give the same result.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.forecasting import holt_winters as hw
from shelfwise.forecasting import lookback as lb
from shelfwise.forecasting import moving_average as ma
from shelfwise.forecasting import optimised_smoothing as hwo
from shelfwise.forecasting import permutation
from shelfwise.forecasting import reservoir as rv
from shelfwise.forecasting import rounds, tree_steps, trees
from shelfwise.functions.columns import code_number, padded_code
from shelfwise.operators import batch, cleaning, evaluation, features, levels, overview, rejects
from shelfwise.plans.batch import stored_row_counts
from shelfwise.plans.incremental import ALERTS, Update, update_batch
from shelfwise.plans.runs import run_rows
from shelfwise.plans.training import Training, train_all
from shelfwise.schema import ROW_KEYS, SERIES_KEYS
from shelfwise.sources import star
from shelfwise.sources.files import folder_state, read_sales_csv, shared_dir, stage_path, staged, write_sales_csv, write_table

Query = Callable[[SparkSession, str], DataFrame]

ONE_STORE, ONE_PRODUCT = "ASIA", "PROMO"
HOLIDAY_YEARS = (1990, 2010)
ORIGIN = dt.date(1995, 1, 1)
FEATURES_FROM = dt.date(2000, 1, 1)
FIXED_SMOOTHING = [(0.1, 0.01, 0.1)]
HORIZON = 14
LOOKBACK = 30
# Weights for the recursive forecast with given weights: linear, newest largest.
FIXED_WEIGHTS = [i / 465 for i in range(1, LOOKBACK + 1)]
# A small reservoir and a read-out with given weights.
FIXED_RESERVOIR = rv.Reservoir(0.5, (0.6, -0.4, 0.8), (0.1, 0.0, -0.2))
FIXED_READOUT = rv.Readout(FIXED_RESERVOIR, (*[0.8 * w for w in FIXED_WEIGHTS], 0.1, -0.2, 0.05), 0.02)
FIXED_DELTA = 0.1


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return star.sales_daily(spark, sf)


def dense(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.dense_series(daily(spark, sf))


def holidays(spark: SparkSession) -> DataFrame:
    return star.yearly_holidays(spark, *HOLIDAY_YEARS)


def fact(spark: SparkSession, sf: str) -> DataFrame:
    """Daily sales with the calendar columns of the declared fact schema."""
    rows = features.add_calendar_features(daily(spark, sf), holidays(spark))
    return rows.select(
        *ROW_KEYS, "category", "units", "stock", "is_holiday", "dow", "month", "iso_week", "quarter"
    )


def type_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with the part type as product: few series, many lines a day."""
    return star.sales_lines(spark, sf).withColumn("product", F.col("category"))


def features_of(spark: SparkSession, sf: str) -> DataFrame:
    return features.feature_matrix(dense(spark, sf), holidays(spark))


def scaled_series(spark: SparkSession, sf: str) -> DataFrame:
    return features.min_max_scaled(features.temporal_split(dense(spark, sf)))


def sequences(spark: SparkSession, sf: str) -> DataFrame:
    return features.lookback_sequences(scaled_series(spark, sf), LOOKBACK)


def load_sales(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{shared_dir(spark)}/sales-feed-{uuid.uuid4().hex}"
    return read_sales_csv(spark, write_sales_csv(fact(spark, sf), path))


def clean_sales(spark: SparkSession, sf: str) -> DataFrame:
    feed = star.raw_feed(spark, sf)
    return cleaning.clean_sales(feed, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]).select(
        *ROW_KEYS, "category", "units", "stock"
    )


def duplicate_count(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.duplicate_count(star.raw_feed(spark, sf))


def feed_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Facts and rejects of the raw feed, by reason."""
    return rejects.feed_counts(rejects.judged_feed(star.raw_feed(spark, sf)))


def feed_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Each rejected line, why, and where it stands."""
    return rejects.rejects_of(rejects.judged_feed(star.raw_feed(spark, sf)), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


def product_codes(spark: SparkSession, sf: str) -> DataFrame:
    code = padded_code("PROD", F.col("p_partkey"), 3)
    return star.table(spark, sf, "part").select(
        code.alias("product"), code_number(code).alias("number")
    )


def category_lookup(spark: SparkSession, sf: str) -> DataFrame:
    names = star.table(spark, sf, "part").select(F.col("p_partkey").alias("product"), F.col("p_type").alias("category"))
    lines = star.sales_lines(spark, sf).select(*ROW_KEYS, "units")
    return cleaning.with_category(lines, names)


def series_one(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.one_series(daily(spark, sf), ONE_STORE, ONE_PRODUCT)


def daily_store_aggregates(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.with_holiday_flag(daily(spark, sf), holidays(spark))
    return rounded(batch.daily_store_aggregates(rows, cleaned=True), "units_mean")


def daily_store_aggregates_lines(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.with_holiday_flag(type_lines(spark, sf), holidays(spark))
    return rounded(batch.daily_store_aggregates(rows), "units_mean")


def weekly_category_stats(spark: SparkSession, sf: str, iso_years: bool = False) -> DataFrame:
    stats = batch.weekly_category_stats(daily(spark, sf), iso_years)
    return rounded(stats, "units_mean", "units_std")


def weekly_category_stats_iso(spark: SparkSession, sf: str) -> DataFrame:
    return weekly_category_stats(spark, sf, iso_years=True)


def top_products_by_store(spark: SparkSession, sf: str) -> DataFrame:
    return batch.top_products_by_store(star.sales_lines(spark, sf))


def rolling_mean_range(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(batch.rolling_mean_range(daily(spark, sf)), "rolling_mean_7d")


def rolling_mean_range_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = type_lines(spark, sf).select(*ROW_KEYS, "units")
    return rounded(batch.rolling_mean_range_lines(lines), "rolling_mean_7d")


def alerts(spark: SparkSession, sf: str) -> DataFrame:
    return batch.stock_alerts(daily(spark, sf))


def stock_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(alerts(spark, sf), "units_mean_prev7")


def stock_alerts_parts(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(batch.stock_alerts(star.part_daily(spark, sf)), "units_mean_prev7")


def stock_alerts_report(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(batch.stock_alerts_report(alerts(spark, sf)), "units_mean_prev7")


def latest_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(batch.latest_alerts(alerts(spark, sf)), "units_mean_prev7")


def alert_counts(spark: SparkSession, sf: str) -> DataFrame:
    return batch.alert_counts(alerts(spark, sf))


# The first feed ends where the second one has begun already, so half a year comes twice.
SECOND_FEED_FROM, FIRST_FEED_UNTIL = dt.date(1999, 7, 1), dt.date(2000, 1, 1)


def two_feeds(spark: SparkSession, sf: str) -> tuple[str, Update]:
    """The folder of an incremental batch after two feeds, and what the second brought."""

    def update() -> tuple[str, Update]:
        rows, out = staged(fact(spark, sf), "feed"), stage_path(spark, "incremental")
        day = F.col("sale_date")
        feeds = [rows.where(day < FIRST_FEED_UNTIL), rows.where(day >= SECOND_FEED_FROM)]
        results = [update_batch(spark, write_sales_csv(part, stage_path(spark, "feed")), out) for part in feeds]
        return out, results[-1]

    return shared(spark, sf, "two feeds", update)


def incremental_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """The alert report that two feeds in a row leave."""
    report = spark.read.parquet(f"{two_feeds(spark, sf)[0]}/{ALERTS}").drop("sale_month")
    return rounded(report.withColumn("stock", F.col("stock").cast("long")), "units_mean_prev7")


def incremental_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Where the lines of the second feed went."""
    found = two_feeds(spark, sf)[1]
    row = (found.lines, found.rejected, found.copies, found.seen_before, found.added, len(found.months))
    return spark.createDataFrame([row], "lines long, rejected long, copies long, seen_before long, added long, months long")


def stored_reports(spark: SparkSession, sf: str) -> dict[str, str]:
    """The paths of the batch reports, written from one staged table of daily sales."""

    def write() -> dict[str, str]:
        rows = staged(daily(spark, sf), "daily")
        reports = {
            "daily_store_aggregates": batch.daily_store_aggregates(features.with_holiday_flag(rows, holidays(spark)), cleaned=True),
            "weekly_category_stats": batch.weekly_category_stats(rows),
            "top_products_by_store": batch.top_products_by_store(rows),
            "stock_alerts": batch.stock_alerts_report(batch.stock_alerts(rows), ordered=False),
        }
        return {name: write_table(report, stage_path(spark, name)) for name, report in reports.items()}

    return shared(spark, sf, "reports", write)


def output_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    return stored_row_counts(spark, stored_reports(spark, sf))


def store_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(overview.store_kpis(daily(spark, sf)), "units_per_day", "stock_mean")


def daily_total_ma7(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(overview.daily_total_moving_average(daily(spark, sf)), "moving_average_7")


def category_sales(spark: SparkSession, sf: str) -> DataFrame:
    return overview.category_sales(daily(spark, sf))


def dow_seasonality(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(overview.dow_seasonality(daily(spark, sf)), "units_mean")


def dataset_profile(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(overview.dataset_profile(daily(spark, sf)), "units_mean")


def distinct_stores(spark: SparkSession, sf: str) -> DataFrame:
    return overview.distinct_values(daily(spark, sf), "store")


def distinct_products(spark: SparkSession, sf: str) -> DataFrame:
    return overview.distinct_values(star.sales_lines(spark, sf), "product")


def calendar_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.add_calendar_features(daily(spark, sf), holidays(spark))
    return rows.select(*ROW_KEYS, *features.CALENDAR_FEATURES)


def lag_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.add_lags(dense(spark, sf))


def rolling_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.add_rolling(dense(spark, sf)), *features.rolling_names())


def feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features_of(spark, sf), *features.rolling_names())


def feature_matrix_from(spark: SparkSession, sf: str) -> DataFrame:
    recent = cleaning.dense_series(daily(spark, sf), features.reach_before(FEATURES_FROM))
    rows = features.feature_matrix(recent, holidays(spark), FEATURES_FROM)
    return rounded(rows, *features.rolling_names())


def temporal_split(spark: SparkSession, sf: str) -> DataFrame:
    return features.temporal_split(dense(spark, sf))


def minmax_scale(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(scaled_series(spark, sf), "scaled")


def lookback_sequences(spark: SparkSession, sf: str) -> DataFrame:
    """The sequences, shown by their ends, their mean and a sum weighted by position."""
    weighted = F.aggregate(
        F.transform("lookback", lambda x, i: x * (i + 1)), F.lit(0.0), lambda acc, x: acc + x
    )
    total = F.aggregate("lookback", F.lit(0.0), lambda acc, x: acc + x)
    shown = sequences(spark, sf).select(
        *ROW_KEYS,
        "part",
        F.element_at("lookback", 1).alias("oldest"),
        F.element_at("lookback", -1).alias("newest"),
        (total / LOOKBACK).alias("mean"),
        weighted.alias("weighted"),
        "target",
    )
    return rounded(shown, "oldest", "newest", "mean", "weighted", "target")


def validation_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.validation_split(sequences(spark, sf)).select(*ROW_KEYS, "role", "target")
    return rounded(rows, "target")


def deseasonalised_sales(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.deseasonalised_sales(daily(spark, sf), holidays(spark), ORIGIN)
    return rounded(
        rows.select(*ROW_KEYS, "units", "seasonal_index", "units_deseasonalised"),
        "seasonal_index",
        "units_deseasonalised",
    )


def ma_forecast(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ma.moving_average_forecast(dense(spark, sf)), "predicted")


def ma_horizon(spark: SparkSession, sf: str) -> DataFrame:
    fit = ma.moving_average_fit(dense(spark, sf))
    return rounded(ma.moving_average_predict(fit, HORIZON), "predicted")


def horizon_errors(spark: SparkSession, sf: str) -> DataFrame:
    rows = dense(spark, sf)
    ahead = ma.moving_average_predict(ma.moving_average_fit(rows), HORIZON).unionByName(
        hw.holt_winters_predict(hw.holt_winters_fit(rows), HORIZON)
    )
    return evaluation.forecast_errors(evaluation.with_actuals(ahead, rows))


def shown_fit(fit: DataFrame) -> DataFrame:
    season = {f"season_{i + 1}": F.round(F.get("season", F.lit(i)), 6) for i in range(7)}
    return rounded(fit.withColumns(season).drop("season"), "level", "trend", "aic").withColumn(
        "sse", F.round("sse", 4)
    )


def hw_fit_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return shown_fit(hw.holt_winters_fit(dense(spark, sf), FIXED_SMOOTHING))


def hw_grid_best(spark: SparkSession, sf: str) -> DataFrame:
    return shown_fit(hw.holt_winters_fit(dense(spark, sf)))


def hw_forecast(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(hw.holt_winters_forecast(dense(spark, sf)), "predicted")


def hw_horizon(spark: SparkSession, sf: str) -> DataFrame:
    fit = hw.holt_winters_fit(dense(spark, sf), FIXED_SMOOTHING)
    return rounded(hw.holt_winters_predict(fit, HORIZON), "predicted")


def hw_optimised_fit(spark: SparkSession, sf: str) -> DataFrame:
    """The optimised fit of each series against the grid's, replayed from its parameters and states."""
    return hwo.checked_fit(dense(spark, sf)).withColumn("grid_sse", F.round("grid_sse", 4))


def hw_optimised_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return coverage(hwo.optimised_forecast(dense(spark, sf)))


def statistical_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    rows = dense(spark, sf)
    return ma.moving_average_forecast(rows).unionByName(hw.holt_winters_forecast(rows))


def forecast_errors(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.forecast_errors(statistical_forecasts(spark, sf))


def compare_models(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.compare_models(forecast_errors(spark, sf))


def best_model(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.best_model(compare_models(spark, sf))


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    records = run_rows(forecast_errors(spark, sf), {"test_fraction": 0.2})
    return records.select("run_name", "model", "metric", "value")


def forecast_curves(spark: SparkSession, sf: str) -> DataFrame:
    split = features.temporal_split(dense(spark, sf))
    return rounded(evaluation.forecast_curves(split, statistical_forecasts(spark, sf)), "value")


# Tables and models that several queries share, by application, folder and name, with the state of the
# folder's files that they were made from.
_SHARED: dict[tuple[str, str, str], tuple[int, object]] = {}


def shared(spark: SparkSession, sf: str, name: str, make: Callable[[], object]):
    """What ``make`` gives, worked out once for an application and a folder whose files stay as they are."""
    key, state = (spark.sparkContext.applicationId, sf, name), folder_state(spark, sf)
    if key not in _SHARED or _SHARED[key][0] != state:
        _SHARED[key] = (state, make())
    return _SHARED[key][1]


def forget_shared() -> None:
    """Drop shared tables and models; ``forget_staged`` deletes the tables' files."""
    _SHARED.clear()


def split_features(spark: SparkSession, sf: str) -> DataFrame:
    def stage() -> DataFrame:
        return staged(features.temporal_split(features_of(spark, sf)), "features", SERIES_KEYS, ["sale_date"])

    return shared(spark, sf, "features", stage)


def forest_of(spark: SparkSession, sf: str):
    return shared(spark, sf, "forest", lambda: trees.random_forest(train_rows(split_features(spark, sf))))


def boosting_of(spark: SparkSession, sf: str):
    return shared(spark, sf, "boosting", lambda: trees.gradient_boosting(train_rows(split_features(spark, sf))))


def regressor_of(spark: SparkSession, sf: str) -> lb.LinearRegressionModel:
    def fit() -> lb.LinearRegressionModel:
        return lb.lookback_fit(features.validation_split(features.lookback_sequences(staged_series(spark, sf), LOOKBACK)))

    return shared(spark, sf, "regressor", fit)


def train_rows(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("part") == "train")


def test_rows(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("part") == "test")


def rf_forecast(spark: SparkSession, sf: str) -> DataFrame:
    return trees.tree_forecast(forest_of(spark, sf), test_rows(split_features(spark, sf)))


def gbt_forecast(spark: SparkSession, sf: str) -> DataFrame:
    return trees.tree_forecast(boosting_of(spark, sf), test_rows(split_features(spark, sf)), trees.GRADIENT_BOOSTING)


def rf_multi_step(spark: SparkSession, sf: str) -> DataFrame:
    """The test days of the forest's feature rows, predicted from their training part alone."""
    return tree_steps.tree_multi_step(forest_of(spark, sf), split_features(spark, sf))


def rf_multi_step_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return coverage(rf_multi_step(spark, sf))


def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    return trees.feature_importance(spark, forest_of(spark, sf), top=12)


def coverage(forecasts: DataFrame) -> DataFrame:
    """What of a fitted model's forecast does not depend on the fit: its days and actuals."""
    usable = F.col("predicted").isNotNull() & ~F.isnan("predicted") & (F.col("predicted") >= 0)
    return forecasts.groupBy(*SERIES_KEYS, "model", "mode").agg(
        F.count(F.lit(1)).alias("days"),
        F.count_if(usable).alias("usable_days"),
        F.min("sale_date").alias("first_day"),
        F.max("sale_date").alias("last_day"),
        F.sum("actual").alias("actual_units"),
    )


def forecast_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Days and actuals of the fitted models' forecasts."""
    return coverage(
        rf_forecast(spark, sf).unionByName(gbt_forecast(spark, sf)).unionByName(lookback_forecast(spark, sf))
    )


def staged_series(spark: SparkSession, sf: str) -> DataFrame:
    def stage() -> DataFrame:
        return staged(scaled_series(spark, sf), "scaled", SERIES_KEYS, ["sale_date"])

    return shared(spark, sf, "scaled", stage)


def lookback_forecast(spark: SparkSession, sf: str) -> DataFrame:
    return lb.lookback_forecast(regressor_of(spark, sf), features.lookback_sequences(staged_series(spark, sf), LOOKBACK))


def lookback_history(spark: SparkSession, sf: str) -> DataFrame:
    return lb.fit_history(spark, regressor_of(spark, sf))


def recursive_forecast(spark: SparkSession, sf: str) -> DataFrame:
    windows = lb.last_windows(staged_series(spark, sf), LOOKBACK)
    return lb.LookbackState(regressor_of(spark, sf), windows).forecast(HORIZON)


def recursive_forecast_fixed(spark: SparkSession, sf: str) -> DataFrame:
    ahead = lb.recursive_forecast(lb.last_windows(scaled_series(spark, sf), LOOKBACK), FIXED_WEIGHTS, 0.0, HORIZON)
    return rounded(ahead.select(*SERIES_KEYS, "sale_date", "predicted"), "predicted")


def validation_loss_fixed(spark: SparkSession, sf: str) -> DataFrame:
    """Mean Huber loss of given weights on the rows that are fitted and those that steer the fit."""
    marked = rv.with_features(features.validation_split(sequences(spark, sf)), rv.Reservoir())
    return rounded(rounds.losses(marked, tuple(FIXED_WEIGHTS), 0.0, FIXED_DELTA), "loss", digits=9)


def lookback_forecast_fixed(spark: SparkSession, sf: str) -> DataFrame:
    """One-step predictions of the linear model with given weights."""
    linear = rv.Readout(rv.Reservoir(), tuple(FIXED_WEIGHTS), 0.0)
    return rounded(linear.forecast(sequences(spark, sf)), "predicted")


def reservoir_forecast_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(FIXED_READOUT.forecast(sequences(spark, sf)), "predicted")


def readout_of(spark: SparkSession, sf: str, name: str) -> rv.Readout:
    units = rv.Reservoir.made() if name == rv.RESERVOIR else rv.Reservoir()

    def fit() -> rv.Readout:
        return rv.fit_readout(features.validation_split(features.lookback_sequences(staged_series(spark, sf), LOOKBACK)), units, LOOKBACK)

    return shared(spark, sf, name, fit)


def sequence_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.lookback_sequences(staged_series(spark, sf), LOOKBACK)
    return readout_of(spark, sf, rv.LINEAR).forecast(rows).unionByName(readout_of(spark, sf, rv.RESERVOIR).forecast(rows))


def rounds_history(spark: SparkSession, sf: str) -> DataFrame:
    """Both losses of every round of both sequence models."""
    both = [readout_of(spark, sf, name).fit.history(spark).withColumn("model", F.lit(name)) for name in (rv.LINEAR, rv.RESERVOIR)]
    return both[0].unionByName(both[1])


def sequence_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return coverage(sequence_forecasts(spark, sf))


def sequence_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Errors of the linear and the reservoir model, on the same days."""
    return evaluation.forecast_errors(sequence_forecasts(spark, sf))


def standardised_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.standardised(features.temporal_split(feature_matrix(spark, sf)))
    return rounded(rows.select(*ROW_KEYS, "part", *features.FEATURES), *features.FEATURES, digits=4)


# Given weights of a linear model of the features, in feature order.
GIVEN_LINEAR = {name: ((7 * k) % 5 - 2) / 10 for k, name in enumerate(features.FEATURES)}


def permutation_importance_fixed(spark: SparkSession, sf: str) -> DataFrame:
    """Permutation importance of every feature on the test rows, for a linear model with given weights."""
    rows = test_rows(features.temporal_split(feature_matrix(spark, sf)))
    found = rounded(permutation.linear_importance(rows, GIVEN_LINEAR, 1.0), "mae", "mae_exchanged")
    return found.withColumn("importance", F.round(F.col("mae_exchanged") - F.col("mae"), 6))


def series_levels(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(levels.with_series_levels(dense(spark, sf)), *levels.LEVELS)


# Both forests of the comparison below; the forests of the forecasts have the full settings.
IDENTITY_TREES, IDENTITY_DEPTH = 40, 10


def forest_with_levels_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Errors of two forests of the same settings, without and with the levels of store and series."""
    rows = staged(levels.with_series_levels(split_features(spark, sf), dense(spark, sf)), "levelled")
    plain, levelled = features.FEATURES, [*features.FEATURES, *levels.LEVELS]
    found = []
    for name, columns in ((trees.RANDOM_FOREST, plain), (f"{trees.RANDOM_FOREST}_levels", levelled)):
        forest = trees.random_forest(train_rows(rows), columns, IDENTITY_TREES, IDENTITY_DEPTH)
        found.append(trees.tree_forecast(forest, test_rows(rows), name))
    return evaluation.forecast_errors(found[0].unionByName(found[1]))


def four_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    given = lookback_forecast_fixed(spark, sf).unionByName(reservoir_forecast_fixed(spark, sf))
    return statistical_forecasts(spark, sf).unionByName(given)


def compare_four_models(spark: SparkSession, sf: str) -> DataFrame:
    """Four models ranked per series on the days that all of them predicted; the last two have given weights."""
    return evaluation.compare_models(evaluation.forecast_errors(evaluation.on_common_dates(four_forecasts(spark, sf))))


def all_models(spark: SparkSession, sf: str) -> Training:
    """The four models; the forest is the one of ``rf_forecast``, whose feature rows are split by themselves."""
    return train_all(dense(spark, sf), holidays(spark), own_feature_split=True, forest=forest_of(spark, sf))


def compare_all_models(spark: SparkSession, sf: str) -> DataFrame:
    return all_models(spark, sf).comparison()


QUERIES: dict[str, Query] = {
    "load_sales": load_sales,
    "clean_sales": clean_sales,
    "duplicate_count": duplicate_count,
    "feed_counts": feed_counts,
    "feed_rejects": feed_rejects,
    "product_codes": product_codes,
    "category_lookup": category_lookup,
    "dense_series": dense,
    "series_one": series_one,
    "daily_store_aggregates": daily_store_aggregates,
    "daily_store_aggregates_lines": daily_store_aggregates_lines,
    "weekly_category_stats": weekly_category_stats,
    "weekly_category_stats_iso": weekly_category_stats_iso,
    "top_products_by_store": top_products_by_store,
    "rolling_mean_range": rolling_mean_range,
    "rolling_mean_range_lines": rolling_mean_range_lines,
    "stock_alerts": stock_alerts,
    "stock_alerts_parts": stock_alerts_parts,
    "stock_alerts_report": stock_alerts_report,
    "latest_alerts": latest_alerts,
    "alert_counts": alert_counts,
    "incremental_alerts": incremental_alerts,
    "incremental_counts": incremental_counts,
    "output_row_counts": output_row_counts,
    "store_kpis": store_kpis,
    "daily_total_ma7": daily_total_ma7,
    "category_sales": category_sales,
    "dow_seasonality": dow_seasonality,
    "dataset_profile": dataset_profile,
    "distinct_stores": distinct_stores,
    "distinct_products": distinct_products,
    "calendar_features": calendar_features,
    "lag_features": lag_features,
    "rolling_features": rolling_features,
    "feature_matrix": feature_matrix,
    "feature_matrix_from": feature_matrix_from,
    "temporal_split": temporal_split,
    "minmax_scale": minmax_scale,
    "lookback_sequences": lookback_sequences,
    "validation_split": validation_split,
    "deseasonalised_sales": deseasonalised_sales,
    "ma_forecast": ma_forecast,
    "ma_horizon": ma_horizon,
    "hw_fit_fixed": hw_fit_fixed,
    "hw_grid_best": hw_grid_best,
    "hw_forecast": hw_forecast,
    "hw_horizon": hw_horizon,
    "hw_optimised_fit": hw_optimised_fit,
    "hw_optimised_coverage": hw_optimised_coverage,
    "forecast_errors": forecast_errors,
    "horizon_errors": horizon_errors,
    "compare_models": compare_models,
    "best_model": best_model,
    "run_metrics": run_metrics,
    "forecast_curves": forecast_curves,
    "rf_forecast": rf_forecast,
    "gbt_forecast": gbt_forecast,
    "rf_multi_step": rf_multi_step,
    "rf_multi_step_coverage": rf_multi_step_coverage,
    "feature_importance": feature_importance,
    "lookback_forecast": lookback_forecast,
    "lookback_history": lookback_history,
    "recursive_forecast": recursive_forecast,
    "recursive_forecast_fixed": recursive_forecast_fixed,
    "validation_loss_fixed": validation_loss_fixed,
    "lookback_forecast_fixed": lookback_forecast_fixed,
    "reservoir_forecast_fixed": reservoir_forecast_fixed,
    "rounds_history": rounds_history,
    "sequence_coverage": sequence_coverage,
    "sequence_errors": sequence_errors,
    "standardised_features": standardised_features,
    "permutation_importance_fixed": permutation_importance_fixed,
    "series_levels": series_levels,
    "forest_with_levels_errors": forest_with_levels_errors,
    "compare_four_models": compare_four_models,
    "forecast_coverage": forecast_coverage,
    "compare_all_models": compare_all_models,
}
