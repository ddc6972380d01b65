"""Permutation importance: how much worse a model gets when a feature's values change places.

Values change places within a day, so what the calendar says of a day stays true. Each
row gets the value of the row that follows it in the order of a hash of series and feature; the
last gets the first's. All features change places in one pass and one shuffle. A day with more
than ``GROUP`` series is cut into groups by a hash of the series, so that no task holds a day.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.schema import SERIES_KEYS

GROUP = 50_000
FIGURES = "feature string, mae double, mae_exchanged double, importance double"


def _hash(name: str) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in SERIES_KEYS], F.lit(name)).cast("binary"))


def groups_of_a_day(rows: DataFrame, most: int = GROUP) -> int:
    """Into how many groups a day is cut, from how many series there are, roughly."""
    series = rows.agg(F.approx_count_distinct(F.struct(*SERIES_KEYS), 0.02)).first()[0]
    return max(1, math.ceil(series / most))


def exchanged(rows: DataFrame, names: Sequence[str], groups: int = 1) -> DataFrame:
    """``rows`` with a column ``other_<name>`` for each feature: the value of another row of the day."""
    together = [F.col("sale_date")]
    if groups > 1:
        together.append(F.pmod(F.xxhash64(*SERIES_KEYS), F.lit(groups)))
    columns = {}
    for name in names:
        order = Window.partitionBy(*together).orderBy(_hash(name))
        columns[f"other_{name}"] = F.coalesce(F.lead(name).over(order), F.first(name).over(order))
    return rows.withColumns(columns)


def _figures(found: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row of mean errors (``base`` and one a feature) as a row a feature, most important first."""
    each = [F.struct(F.lit(n).alias("feature"), F.col(n).alias("mae_exchanged")) for n in names]
    rows = found.select(F.col("base").alias("mae"), F.explode(F.array(*each)).alias("x")).select("x.feature", "mae", "x.mae_exchanged")
    return rows.withColumn("importance", F.col("mae_exchanged") - F.col("mae")).orderBy(F.desc("importance"), "feature")


def linear_importance(rows: DataFrame, weights: Mapping[str, float], intercept: float = 0.0, groups: int | None = None) -> DataFrame:
    """(feature, mae, mae_exchanged, importance) of a linear model of ``units``."""
    names = list(weights)
    moved = exchanged(rows, names, groups or groups_of_a_day(rows))
    predicted = F.lit(float(intercept))
    for name, weight in weights.items():
        predicted = predicted + F.lit(float(weight)) * F.col(name)
    moved = moved.withColumn("miss", F.col("units") - predicted)
    errors = [F.avg(F.abs("miss")).alias("base")]
    errors += [F.avg(F.abs(F.col("miss") - F.lit(float(w)) * (F.col(f"other_{n}") - F.col(n)))).alias(n) for n, w in weights.items()]
    return _figures(moved.agg(*errors), names)


def model_importance(predict: Callable[[DataFrame], DataFrame], rows: DataFrame, names: Sequence[str], groups: int | None = None) -> DataFrame:
    """The same for any model: ``predict`` adds ``prediction`` to feature rows.

    Each row is predicted as it is and once for each feature, in one pass.
    """
    moved = exchanged(rows, names, groups or groups_of_a_day(rows))
    copies = moved.withColumn("changed", F.explode(F.sequence(F.lit(0), F.lit(len(names)))))
    values = {n: F.when(F.col("changed") == k, F.col(f"other_{n}")).otherwise(F.col(n)) for k, n in enumerate(names, 1)}
    predicted = predict(copies.withColumns(values).select("units", "changed", *names))
    errors = predicted.groupBy().agg(
        *[F.avg(F.when(F.col("changed") == k, F.abs(F.col("units") - F.col("prediction")))).alias(n) for k, n in enumerate(["base", *names])]
    )
    return _figures(errors, names)
