"""A runs table: parameters and metrics of each training run, one row per metric."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.evaluation import METRICS
from shelfwise.sources.files import read_if_exists


def run_rows(
    errors: DataFrame,
    params: Mapping[str, object],
    run_id: str | None = None,
    logged_at: dt.datetime | None = None,
    own_params: Sequence[str] = (),
) -> DataFrame:
    """Model errors as run records; the run name is store_product.

    ``own_params`` names columns of ``errors`` to record as parameters, for what
    differs between series.
    """
    pairs = [(F.lit(name), F.lit(str(value))) for name, value in params.items()]
    pairs += [(F.lit(name), F.col(name).cast("string")) for name in own_params]
    settings = F.create_map(*[column for pair in pairs for column in pair])
    return errors.select(
        F.lit(run_id or uuid.uuid4().hex).alias("run_id"),
        F.concat_ws("_", "store", "product").alias("run_name"),
        F.lit(logged_at or dt.datetime.now()).alias("logged_at"),
        settings.cast("map<string,string>").alias("params"),
        "model",
        *METRICS,
    ).unpivot(["run_id", "run_name", "logged_at", "params", "model"], METRICS, "metric", "value")


def log_run(
    errors: DataFrame,
    params: Mapping[str, object],
    path: str,
    run_id: str | None = None,
    own_params: Sequence[str] = (),
) -> str:
    """Add a run to the runs table and return its id.

    The rows go to a folder of this attempt. A line in the list of committed attempts, one task's
    one row and so written whole or not at all, comes last and makes them visible to
    ``read_runs``. A run id that is logged again replaces its earlier attempt.
    """
    run_id, attempt = run_id or uuid.uuid4().hex, uuid.uuid4().hex
    rows = run_rows(errors, params, run_id, own_params=own_params)
    marks = {"run": F.lit(f"run_{run_id}"), "attempt": F.lit(f"attempt_{attempt}")}
    rows.withColumns(marks).write.mode("append").partitionBy("run", "attempt").parquet(path)
    commit(errors.sparkSession, path, f"run_{run_id}", f"attempt_{attempt}")
    return run_id


def committed_path(path: str) -> str:
    return f"{path.rstrip('/')}_committed"


def commit(spark: SparkSession, path: str, run: str, attempt: str) -> None:
    """Make an attempt the one that counts for its run."""
    line = spark.createDataFrame([(run, attempt, dt.datetime.now())], "run string, attempt string, committed_at timestamp")
    line.coalesce(1).write.mode("append").parquet(committed_path(path))


def read_runs(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of every committed run, of its latest attempt; ``None`` before the first commit."""
    spark.catalog.refreshByPath(committed_path(path))
    lines = read_if_exists(spark, committed_path(path))
    if lines is None:
        return None
    spark.catalog.refreshByPath(path)
    latest = lines.groupBy("run").agg(F.max_by("attempt", F.struct("committed_at", "attempt")).alias("attempt"))
    return spark.read.parquet(path).join(latest, ["run", "attempt"], "left_semi").drop("run", "attempt")
