import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.operators.cleaning import (
    clean_sales,
    dense_series,
    duplicate_count,
    one_series,
    with_category,
)


def raw(spark, rows):
    return spark.createDataFrame(
        rows, "sale_date string, store string, product string, units string, stock string, seq int"
    )


def test_text_measures_become_non_negative_numbers(spark):
    texts = ["abc", "-3", "NaN", None, "2.5", " 7 ", "1e2"]
    rows = [(f"2022-01-{i + 1:02d}", "S", "P", text, text, i) for i, text in enumerate(texts)]
    out = clean_sales(raw(spark, rows)).orderBy("sale_date").collect()
    assert [r.units for r in out] == [0.0, 0.0, 0.0, 0.0, 2.5, 7.0, 100.0]
    assert [r.stock for r in out] == [r.units for r in out]


def test_first_copy_by_order_wins_not_physical_order(spark):
    rows = [("2022-01-01", "S", "P", str(i), "1", 100 - i) for i in range(100)]
    df = raw(spark, rows).repartition(7)
    assert clean_sales(df, ["seq"]).collect()[0].units == 99.0
    assert duplicate_count(df).collect()[0].asDict() == {
        "rows_before": 100, "rows_after": 1, "duplicates": 99,
    }


def test_bad_dates_become_null_and_stay_out_of_series(spark):
    rows = [("2022-02-30", "S", "P", "1", "1", 0), ("2022-02-01", "S", "P", "2", "1", 1)]
    cleaned = clean_sales(raw(spark, rows))
    assert cleaned.where(F.col("sale_date").isNull()).count() == 1
    assert [r.units for r in dense_series(cleaned).collect()] == [2.0]


def test_no_row_is_lost_to_its_date(spark):
    days = ["2022-01-01 00:00:00", "2022-01-02T10:30:00", "2022-1-3", "2022-01-04", "04.01.2022", "05.01.2022", "05.01.2022", None]
    df = raw(spark, [(day, "S", "P", str(i), "1", i) for i, day in enumerate(days)])
    cleaned = clean_sales(df, ["seq"])
    assert sorted(str(r.sale_date) for r in cleaned.collect()) == [f"2022-01-0{d}" for d in (1, 2, 3, 4)] + ["None"] * 3
    assert sorted(r.units for r in cleaned.where("sale_date is null").collect()) == [4.0, 5.0, 7.0]
    counts = duplicate_count(df).collect()[0]
    assert (counts.rows_before, counts.rows_after, counts.duplicates) == (8, cleaned.count(), 1)


def test_ordered_output_is_sorted_by_series_and_date(spark):
    rows = [
        (f"2022-01-{d:02d}", s, p, "1", "1", 0) for d in (3, 1, 2) for s in "BA" for p in ("y", "x")
    ]
    out = clean_sales(raw(spark, rows), ordered=True).collect()
    keys = [(r.store, r.product, r.sale_date) for r in out]
    assert keys == sorted(keys)


def test_empty_input_counts_no_duplicates(spark):
    row = duplicate_count(raw(spark, [])).collect()[0]
    assert (row.rows_before, row.rows_after, row.duplicates) == (0, 0, 0)


def test_gaps_are_filled_with_zero_between_first_and_last_sale_only(sales):
    df = sales([("S", "P", "2022-02-26", 5, 1), ("S", "P", "2022-03-02", 7, 1), ("S", "Q", "2022-03-01", 1, 1)])
    out = dense_series(df).orderBy("product", "sale_date").collect()
    assert [(r.product, r.sale_date.isoformat(), r.units) for r in out] == [
        ("P", "2022-02-26", 5.0),
        ("P", "2022-02-27", 0.0),
        ("P", "2022-02-28", 0.0),
        ("P", "2022-03-01", 0.0),
        ("P", "2022-03-02", 7.0),
        ("Q", "2022-03-01", 1.0),
    ]


def test_a_repeated_day_is_an_error(sales):
    df = sales([("S", "P", "2022-01-01", 5, 1), ("S", "P", "2022-01-01", 6, 1)])
    with pytest.raises(Exception, match="sequence|boundaries"):
        dense_series(df).collect()


def test_one_series_needs_rows(sales):
    df = sales([("S", "P", "2022-01-01", 5, 1)])
    assert one_series(df, "S", "P").count() == 1
    with pytest.raises(ValueError, match="no rows"):
        one_series(df, "S", "other")


def test_unknown_products_get_the_default_category(spark, sales):
    df = sales([("S", "P", "2022-01-01", 5, 1), ("S", "Q", "2022-01-01", 5, 1)])
    names = spark.createDataFrame([("P", "Hogar")], "product string, category string")
    out = {r.product: r.category for r in with_category(df, names).collect()}
    assert out == {"P": "Hogar", "Q": "Otros"}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(
        st.tuples(st.sampled_from("AB"), st.integers(0, 40)), st.integers(0, 50), min_size=1, max_size=25
    )
)
def test_dense_series_has_every_day_and_keeps_the_total(sales, sold):
    first = dt.date(2023, 12, 20)
    rows = [
        ("S", p, (first + dt.timedelta(days=d)).isoformat(), units, 1) for (p, d), units in sold.items()
    ]
    out = dense_series(sales(rows)).collect()
    for p in {p for p, _ in sold}:
        days = sorted(d for q, d in sold if q == p)
        mine = sorted((r.sale_date - first).days for r in out if r.product == p)
        assert mine == list(range(days[0], days[-1] + 1))
        assert sum(r.units for r in out if r.product == p) == sum(u for (q, _), u in sold.items() if q == p)


def test_codes_are_padded_and_parsed(spark):
    from shelfwise.functions.columns import code_number, padded_code

    df = spark.range(7, 9).withColumn("code", padded_code("PROD", F.col("id"), 3))
    df = df.withColumn("number", code_number(F.col("code")))
    assert [(r.code, r.number) for r in df.orderBy("id").collect()] == [("PROD_007", 7), ("PROD_008", 8)]
    assert spark.range(1).select(code_number(F.lit("none")).alias("n")).collect()[0].n is None


def test_integer_measures_stay_integers(spark, sales):
    df = sales([("S", "P", "2022-01-01", -5, -1)])
    out = clean_sales(df)
    assert dict(out.dtypes)["stock"] == "int" and (out.collect()[0].units, out.collect()[0].stock) == (0.0, 0)
