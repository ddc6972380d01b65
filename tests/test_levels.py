"""Levels of store and series see earlier days only."""

import datetime as dt

import pytest

from shelfwise.operators.levels import STRENGTH, store_levels, with_series_levels

FIELDS = "store string, product string, sale_date date, units double"


def rows_of(spark, values):
    start = dt.date(2022, 1, 1)
    return spark.createDataFrame([(s, p, start + dt.timedelta(days=d), float(u)) for s, p, d, u in values], FIELDS)


VALUES = [(s, p, d, (k + 1) * 10 + d % 5) for k, (s, p) in enumerate([("A", "x"), ("A", "y"), ("B", "x")]) for d in range(3 * k, 30)]


def plain(values):
    out = {}
    for s, p, d, u in values:
        earlier = [r for r in values if r[2] < d]
        level = sum(r[3] for r in earlier) / len(earlier) if earlier else 0.0
        store = [r[3] for r in earlier if r[0] == s]
        store_level = (sum(store) + STRENGTH * level) / (len(store) + STRENGTH)
        own = [r[3] for r in earlier if r[:2] == (s, p)]
        out[s, p, d] = ((sum(own) + STRENGTH * store_level) / (len(own) + STRENGTH), store_level)
    return out


def found(df):
    return {(r.store, r["product"], (r.sale_date - dt.date(2022, 1, 1)).days): (r.series_level, r.store_level) for r in df.collect()}


def test_levels_match_the_definition(spark):
    want = plain(VALUES)
    got = found(with_series_levels(rows_of(spark, VALUES)))
    assert got.keys() == want.keys()
    for key, levels in want.items():
        assert got[key] == pytest.approx(levels)


def test_later_days_change_nothing(spark):
    changed = [(s, p, d, u if d < 20 else u * 50) for s, p, d, u in VALUES]
    before, after = (found(with_series_levels(rows_of(spark, v))) for v in (VALUES, changed))
    assert all(before[k] == after[k] for k in before if k[2] <= 20) and any(before[k] != after[k] for k in before if k[2] > 20)


def test_some_rows_are_levelled_by_all_days(spark):
    table = rows_of(spark, VALUES)
    late = table.where("sale_date > '2022-01-20'")
    got, whole = found(with_series_levels(late, table)), found(with_series_levels(table))
    assert got == {k: whole[k] for k in got} and len(got) == late.count()


def test_first_day_and_empty_table(spark):
    table = rows_of(spark, [("A", "x", 0, 7)])
    assert found(with_series_levels(table)) == {("A", "x", 0): (0.0, 0.0)}
    assert with_series_levels(table.limit(0)).count() == 0 and store_levels(table.limit(0)).count() == 0
