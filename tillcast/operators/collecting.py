"""Layouts of multi-step forecasts.

The long form has one row per series, origin and step: ``origin`` is the last date known when
the forecast was made, ``step`` counts from 1, ``ds`` is the date forecast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def by_target(long: DataFrame, keys: list[str], steps: int) -> DataFrame:
    """One row per date with ``yhat1..n``: the forecast for it made i steps before."""
    columns = [F.max(F.when(F.col("step") == i, F.col("yhat"))).alias(f"yhat{i}") for i in range(1, steps + 1)]
    return long.groupBy(*keys, "ds").agg(*columns)


def by_origin(long: DataFrame, keys: list[str], steps: int) -> DataFrame:
    """One row per start date (the day after the origin) with ``step0..n-1``."""
    columns = [F.max(F.when(F.col("step") == i, F.col("yhat"))).alias(f"step{i - 1}") for i in range(1, steps + 1)]
    return long.groupBy(*keys, F.date_add("origin", 1).alias("ds")).agg(*columns)


def latest(long: DataFrame, keys: list[str], previous: int = 0) -> DataFrame:
    """The latest forecast of each series and up to ``previous`` earlier ones; ``age`` counts back."""
    age = F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.desc("origin"))) - 1
    return long.withColumn("age", age).where(F.col("age") <= previous)


def with_history(latest_forecast: DataFrame, history: DataFrame, keys: list[str]) -> DataFrame:
    """History rows (``y``) and forecast rows (``yhat``) in one frame."""
    past = history.select(*keys, "ds", F.col("y").cast("double").alias("y"))
    return past.unionByName(latest_forecast.select(*keys, "ds", "yhat"), allowMissingColumns=True)


def day_ahead(wide: DataFrame, requests: DataFrame, keys: list[str], steps: int = 24) -> DataFrame:
    """Values of one origin read off the target layout.

    The target row ``i`` steps after ``start`` holds the value wanted in its column ``yhat{i}``.
    ``requests`` has the keys and ``start``. A request that is not fully covered comes back with
    ``complete = false`` instead of stopping the job.
    """
    wanted = requests.select(*keys, "start", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    wanted = wanted.withColumn("ds", F.col("start") + F.make_dt_interval(hours=F.col("step")))
    values = F.array(*[F.col(f"yhat{i}") for i in range(1, steps + 1)])
    joined = wanted.join(wide.select(*keys, "ds", values.alias("_v")), [*keys, "ds"], "left")
    value = F.col("_v")[F.col("step") - 1]
    found = F.count(value).over(Window.partitionBy(*keys, "start"))
    return joined.select(*keys, "start", "step", "ds", value.alias("yhat"), (found == steps).alias("complete"))
