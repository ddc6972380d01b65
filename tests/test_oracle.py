"""Every query that SQL can express, against DuckDB on the smallest tables."""

from pathlib import Path

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from shelfwise.plans.oracle import ORACLE
from shelfwise.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the generated tables")

FITTED = {
    "rf_forecast", "gbt_forecast", "feature_importance", "lookback_forecast", "lookback_history",
    "recursive_forecast", "compare_all_models", "rounds_history", "sequence_errors",
    "forest_with_levels_errors", "rf_multi_step",
}


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_only_fitted_models_have_no_sql():
    assert set(QUERIES) - set(ORACLE) == FITTED
    assert set(ORACLE) <= set(QUERIES) <= set(queries())


def test_dates_leave_as_text_and_stay_dates_inside(spark):
    assert dict(queries()["dense_series"](spark, FOLDER).dtypes)["sale_date"] == "string"
    assert dict(QUERIES["dense_series"](spark, FOLDER).dtypes)["sale_date"] == "date"


def test_flagship_query_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, db, name):
    assert differences(queries()[name](spark, FOLDER), db, oracle_sql()[name]) == []


@pytest.mark.parametrize("name", ["rf_forecast", "lookback_forecast"])
def test_fitted_models_predict_every_test_day(spark, name):
    out = queries()[name](spark, FOLDER)
    assert out.count() > 0 and out.where("predicted is null or predicted < 0 or isnan(predicted)").count() == 0
