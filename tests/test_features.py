import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import features as ft
from shelfwise.sources.star import yearly_holidays


def values(n, seed=3):
    draw = random.Random(seed)
    return [draw.randint(0, 40) for _ in range(n)]


def by_day(df, *names):
    return df.orderBy("product", "sale_date").select(*names).collect()


def test_calendar_features_of_known_days(series, holidays):
    df = ft.add_calendar_features(series({"P": [1] * 400}), holidays)
    row = df.where("sale_date = '2022-01-07'").collect()[0]
    assert (row.dow, row.month, row.iso_week, row.quarter) == (4, 1, 1, 1)
    assert (row.is_weekend, row.is_month_start, row.is_month_end) == (0, 0, 0)
    assert (row.is_holiday, row.is_day_after_holiday, row.is_black_friday) == (0, 1, 0)
    new_year = df.where("sale_date = '2022-01-01'").collect()[0]
    assert (new_year.iso_week, new_year.is_holiday, new_year.is_weekend, new_year.is_month_start) == (52, 1, 1, 1)
    assert df.count() == 400


def test_a_holiday_after_a_holiday_has_both_flags(spark, series):
    two = spark.createDataFrame([(dt.date(2022, 1, 2),), (dt.date(2022, 1, 3),)], "holiday date")
    out = by_day(ft.add_calendar_features(series({"P": [1] * 5}), two), "is_holiday", "is_day_after_holiday")
    assert [tuple(r) for r in out] == [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]


@pytest.mark.parametrize("year, expected", [(2018, [23, 30]), (2022, [25]), (2023, [24])])
def test_black_friday_rule(series, holidays, year, expected):
    df = ft.add_calendar_features(series({"P": [1] * 30}, f"{year}-11-01"), holidays)
    assert [r.sale_date.day for r in df.where("is_black_friday = 1").orderBy("sale_date").collect()] == expected


def test_history_features_equal_pandas(series):
    data = values(60)
    out = by_day(ft.add_rolling(ft.add_lags(series({"P": data}))), "*")
    units = pd.Series(data, dtype=float)
    shifted = units.shift(1)
    expected = {f"lag_{k}": units.shift(k) for k in ft.LAGS}
    for size in ft.ROLLING_WINDOWS:
        expected[f"rolling_mean_{size}"] = shifted.rolling(size).mean()
        expected[f"rolling_std_{size}"] = shifted.rolling(size).std()
    expected["rolling_max_7"] = shifted.rolling(7).max()
    for name, column in expected.items():
        got = pd.Series([r[name] for r in out], dtype=float)
        assert (got.isna() == column.isna()).all(), name
        np.testing.assert_allclose(got.dropna(), column.dropna(), atol=1e-9, err_msg=name)


@pytest.mark.parametrize("windows", [[2], [1, 3], [7, 13, 20], [30, 7, 14, 90], [5, 6, 7]])
def test_any_windows_equal_pandas(series, windows):
    data = [x / 7 + 1000 for x in values(120)]
    out = by_day(ft.add_rolling(series({"P": data}), windows), "*")
    shifted = pd.Series(data).shift(1)
    for size in windows:
        for kind in ("mean", "std"):
            column = getattr(shifted.rolling(size), kind)()
            got = pd.Series([r[f"rolling_{kind}_{size}"] for r in out], dtype=float)
            assert (got.isna() == column.isna()).all(), (kind, size)
            np.testing.assert_allclose(got.dropna(), column.dropna(), atol=1e-7)


def test_a_missing_value_empties_its_windows_as_in_pandas(series):
    data = values(80)
    df = series({"P": data}).withColumn("units", F.when(F.dayofyear("sale_date") != 25, F.col("units")))
    out = by_day(ft.add_rolling(df), "*")
    shifted = pd.Series([float("nan") if i == 24 else float(x) for i, x in enumerate(data)]).shift(1)
    for size in ft.ROLLING_WINDOWS:
        expected = shifted.rolling(size).mean()
        got = pd.Series([r[f"rolling_mean_{size}"] for r in out], dtype=float)
        assert (got.isna() == expected.isna()).all()


def test_constant_series_has_no_deviation(series):
    out = by_day(ft.add_rolling(series({"P": [5] * 40})), "rolling_std_30", "rolling_mean_7")
    assert out[-1].rolling_std_30 == 0.0 and out[-1].rolling_mean_7 == 5.0


def test_feature_matrix_drops_the_warm_up_only(series, holidays):
    df = series({"a": values(31), "b": values(30), "c": values(100)})
    out = ft.feature_matrix(df, holidays)
    assert out.columns == ["store", "product", "sale_date", "units", *ft.FEATURES]
    assert {r.product: r["count"] for r in out.groupBy("product").count().collect()} == {"a": 1, "c": 70}
    assert out.where("product = 'c'").agg(F.min("days_since_start")).collect()[0][0] == 30


def test_no_feature_looks_at_its_day_or_later(series, holidays):
    data = values(70)
    changed = data[:50] + [999] * 20
    before = ft.feature_matrix(series({"P": data}), holidays).orderBy("sale_date").drop("units").collect()
    after = ft.feature_matrix(series({"P": changed}), holidays).orderBy("sale_date").drop("units").collect()
    day_50 = dt.date(2022, 1, 1) + dt.timedelta(days=50)
    assert [r for r in before if r.sale_date <= day_50] == [r for r in after if r.sale_date <= day_50]
    assert before[-1] != after[-1]


def test_features_from_a_date_equal_the_filtered_matrix(series, holidays):
    df = series({"a": values(120), "b": values(45), "c": values(80, 9)})
    start = dt.date(2022, 2, 10)
    whole = ft.feature_matrix(df, holidays).where(F.col("sale_date") >= start)
    part = ft.feature_matrix(df, holidays, start)
    order = ["product", "sale_date"]
    assert part.orderBy(*order).collect() == whole.orderBy(*order).collect()


def test_available_features_keeps_order(series, holidays):
    df = ft.add_lags(ft.add_calendar_features(series({"P": [1]}), holidays)).drop("month", "lag_7")
    assert ft.available_features(df) == [
        n for n in ft.FEATURES if n in ft.CALENDAR_FEATURES + [f"lag_{k}" for k in ft.LAGS] and n not in ("month", "lag_7")
    ]


@pytest.mark.parametrize(
    "n, fraction", [(1, 0.2), (5, 0.2), (7, 0.2), (35, 0.2), (700, 0.2), (730, 0.2), (90, 0.3), (100, 0.15)]
)
def test_split_sizes_follow_double_arithmetic(series, n, fraction):
    out = ft.temporal_split(series({"P": [1] * n}), fraction)
    train = [r.sale_date for r in out.where("part = 'train'").collect()]
    test = [r.sale_date for r in out.where("part = 'test'").collect()]
    assert len(train) == int(n * (1 - fraction)) and len(train) + len(test) == n
    assert not train or max(train) < min(test)


def test_each_series_is_split_by_itself(series):
    out = ft.temporal_split(series({"a": [1] * 10, "b": [1] * 50}))
    counts = {(r.product, r.part): r["count"] for r in out.groupBy("product", "part").count().collect()}
    assert counts == {("a", "train"): 8, ("a", "test"): 2, ("b", "train"): 40, ("b", "test"): 10}


def test_scaling_uses_training_rows_and_inverts(series):
    scaled = ft.min_max_scaled(ft.temporal_split(series({"P": [2, 4, 6, 10, 4, 2, 6, 10, 30, 0]})))
    out = by_day(scaled.withColumn("back", ft.unscale(F.col("scaled"), F.col("scale_min"), F.col("scale_max"))), "*")
    assert [r.scaled for r in out][:4] == [0.0, 0.25, 0.5, 1.0]
    assert out[8].scaled == 3.5 and out[9].scaled == -0.25
    assert all(abs(r.back - r.units) < 1e-12 for r in out)


def test_constant_training_part_scales_to_zero(series):
    scaled = ft.min_max_scaled(ft.temporal_split(series({"P": [5] * 8 + [7, 5]})))
    out = by_day(scaled.withColumn("back", ft.unscale(F.col("scaled"), F.col("scale_min"), F.col("scale_max"))), "*")
    assert [r.scaled for r in out] == [0.0] * 8 + [2.0, 0.0]
    assert [r.back for r in out] == [r.units for r in out]


def test_lookback_sequences(series):
    data = [float(x) for x in range(12)]
    scaled = series({"P": data}).withColumn("scaled", F.col("units")).withColumn("part", F.lit("train"))
    out = by_day(ft.lookback_sequences(scaled, 4), "lookback", "target")
    assert [(r.lookback, r.target) for r in out] == [(data[i - 4 : i], data[i]) for i in range(4, 12)]


@pytest.mark.parametrize("n, held_out", [(5, 1), (14, 1), (34, 4)])
def test_validation_tail_is_at_least_one(series, n, held_out):
    scaled = series({"P": [1] * n}).withColumn("scaled", F.col("units")).withColumn("part", F.lit("train"))
    out = by_day(ft.validation_split(ft.lookback_sequences(scaled, 4)), "role")
    roles = [r.role for r in out]
    assert max(1, int((n - 4) * 0.15)) == held_out
    assert roles == ["fit"] * (n - 4 - held_out) + ["validation"] * held_out


def test_deseasonalised_sales(series, holidays):
    df = series({"P": [100.0] * 700})
    out = {
        r.sale_date: r.seasonal_index
        for r in ft.deseasonalised_sales(df, holidays, dt.date(2022, 1, 1)).collect()
    }
    assert out[dt.date(2022, 1, 1)] == pytest.approx(1.35 * 0.90 * 0.30)
    assert out[dt.date(2022, 11, 25)] == pytest.approx((1 + 0.02 * 328 / 365) * 1.20 * 1.20 * 2.5)
    assert out[dt.date(2023, 1, 2)] == pytest.approx((1 + 0.02 * 366 / 365) * 0.85 * 0.90)


def test_yearly_holidays_are_given_by_year(spark):
    days = [r.holiday for r in yearly_holidays(spark, 2020, 2021).collect()]
    assert len(days) == 18 and dt.date(2021, 12, 25) in days
