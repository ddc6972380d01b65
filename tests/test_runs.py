"""Runs are visible once they are committed, with all their settings."""

import datetime as dt

import pytest

from shelfwise.plans import runs
from shelfwise.plans.runs import log_run, read_runs
from shelfwise.plans.training import recorded_settings, run_training

ERRORS = "store string, product string, model string, mode string, mape double, mae double, rmse double, days long"
WEEK = [12, 5, 7, 9, 20, 30, 15]


def errors(spark, *mapes):
    return spark.createDataFrame([("S", "p", f"m{k}", "multi_step", x, 1.0, 2.0, 9) for k, x in enumerate(mapes)], ERRORS)


def test_a_killed_run_leaves_no_row(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "runs")
    assert read_runs(spark, path) is None
    log_run(errors(spark, 1.0), {}, path, "first")
    with monkeypatch.context() as killed:
        killed.setattr(runs, "commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            log_run(errors(spark, 2.0), {}, path, "second")
    assert {r.run_id for r in read_runs(spark, path).collect()} == {"first"}
    log_run(errors(spark, 3.0), {}, path, "second")
    found = read_runs(spark, path).where("metric = 'mape'").collect()
    assert sorted((r.run_id, r.value) for r in found) == [("first", 1.0), ("second", 3.0)]


def test_a_repeated_run_replaces_its_rows(spark, tmp_path):
    path = str(tmp_path / "runs")
    log_run(errors(spark, 1.0, 2.0), {"a": 1}, path, "same")
    log_run(errors(spark, 5.0), {"a": 2}, path, "same")
    found = read_runs(spark, path)
    assert found.columns == ["run_id", "run_name", "logged_at", "params", "model", "metric", "value"]
    assert [(r.metric, r.value, r.params) for r in found.where("metric = 'mape'").collect()] == [("mape", 5.0, {"a": "2"})]
    other = log_run(errors(spark, 7.0), {}, path)
    assert {r.run_id for r in read_runs(spark, path).collect()} == {"same", other}


def test_settings_hold_the_defaults():
    found = recorded_settings(num_trees=3, common_dates=True)
    assert found["num_trees"] == 3 and found["max_depth"] == 15 and found["lookback"] == 30 and found["optimised"] is True
    assert not {"dense", "holidays", "forest"} & set(found)


def test_a_training_run_records_fits_and_can_be_repeated(spark, sales, holidays, tmp_path):
    rows = [("A", p, (dt.date(2022, 1, 1) + dt.timedelta(days=i)).isoformat(), WEEK[i % 7] * k + i * 7919 % 5, 9) for k, p in enumerate("xy", 1) for i in range(90)]
    quick = {"num_trees": 2, "max_depth": 3, "max_iter": 4, "lookback": 7, "grid": [(0.1, 0.01, 0.1)], "reservoir_units": 3}
    for _ in range(2):
        comparison = run_training(sales(rows), holidays, str(tmp_path), run_id="again", **quick)
    assert {r.model for r in comparison.collect()} == {"moving_average_7d", "holt_winters", "random_forest", "lookback", "reservoir"}
    found = read_runs(spark, str(tmp_path / "runs")).collect()
    assert len(found) == 2 * 5 * 3 and {r.run_id for r in found} == {"again"}
    params = found[0].params
    assert params["reservoir_units"] == "3" and params["test_fraction"] == "0.2" and params["grid"] == "[(0.1, 0.01, 0.1)]"
    assert float(params["holt_winters_aic"]) and int(params["lookback_iterations"]) > 0 and 0 < int(params["reservoir_rounds"]) <= 4
    assert spark.read.parquet(str(tmp_path / "reservoir_history")).where("kept").count() == 1
