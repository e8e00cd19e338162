"""Intervals that widen with the horizon: simulated future changes of the trend.

The future trend changes as often as the past one could and by amounts of the same mean size.
Every draw adds up such changes day by day and a normal residual. All random numbers are hashes
of the series, the draw and the day, so that the result is the same for any partitioning and
after a lost executor.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.operators.decomposable import Design

_RESOLUTION = 1 << 53


def uniform(seed: int, *parts: Column) -> Column:
    """A number above 0 and below 1 that depends on the parts alone."""
    bits = F.xxhash64(F.lit(seed), *parts).bitwiseAND(F.lit(_RESOLUTION - 1))
    return (bits.cast("double") + 0.5) / _RESOLUTION


def normal(seed: int, *parts: Column) -> Column:
    """A standard normal number, by Box and Muller."""
    radius = F.sqrt(-2.0 * F.ln(uniform(seed, F.lit("radius"), *parts)))
    return radius * F.cos(2.0 * math.pi * uniform(seed, F.lit("angle"), *parts))


def residual_spread(fitted: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, sigma``: standard deviation of ``y - yhat`` over the training days."""
    return fitted.groupBy(*keys).agg(F.stddev_samp(F.col("y") - F.col("yhat")).alias("sigma"))


def simulated(
    forecasts: DataFrame,
    models: DataFrame,
    spread: DataFrame,
    keys: list[str],
    design: Design,
    draws: int = 200,
    seed: int = 0,
) -> DataFrame:
    """``keys, ds, yhat, draw, value`` of every draw of the days in ``forecasts`` (``ds, yhat``).

    ``models`` are additive ones of ``design`` and ``spread`` has their ``sigma``. The size of changes is
    the mean absolute one of the fitted trend, their number a day that of the possible ones.
    """
    span = F.greatest(F.col("span"), F.lit(1.0))
    if design.changepoints:
        past = F.slice("coefficients", 3, design.changepoints)
        size = F.aggregate(past, F.lit(0.0), lambda s, c: s + F.abs(c)) / design.changepoints
    else:
        size = F.lit(0.0)
    # Changes lie in the first four fifths of the training days.
    scale = models.select(
        *keys, size.alias("_size"), F.least(design.changepoints / (0.8 * span), F.lit(1.0)).alias("_share"),
        (F.col("cap") / span).alias("_unit"),
    )
    days = forecasts.select(*keys, "ds", "yhat").join(scale, keys).join(spread, keys)
    drawn = days.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    at = [*[F.col(k) for k in keys], F.col("draw"), F.col("ds")]
    side = uniform(seed, F.lit("size"), *at) - 0.5
    jump = -F.col("_size") * F.signum(side) * F.ln(1.0 - 2.0 * F.abs(side))
    changed = F.when(uniform(seed, F.lit("change"), *at) < F.col("_share"), jump).otherwise(0.0)
    order = Window.partitionBy(*keys, "draw").orderBy("ds")
    drawn = drawn.withColumn("_change", changed).withColumn("_slope", F.sum("_change").over(order))
    drift = F.sum("_slope").over(order) * F.col("_unit")
    noise = F.coalesce("sigma", F.lit(0.0)) * normal(seed, F.lit("noise"), *at)
    return drawn.select(*keys, "ds", "yhat", "draw", (F.col("yhat") + drift + noise).alias("value"))


def band(draws: DataFrame, keys: list[str], level: float = 0.8) -> DataFrame:
    """``keys, ds, yhat, yhat_lower, yhat_upper``: the middle ``level`` of the draws of each day."""
    outside = (1.0 - level) / 2
    both = F.percentile("value", F.array(F.lit(outside), F.lit(1.0 - outside)))
    found = draws.groupBy(*keys, "ds").agg(F.first("yhat").alias("yhat"), both.alias("_q"))
    return found.select(
        *keys, "ds", "yhat", F.col("_q")[0].alias("yhat_lower"), F.col("_q")[1].alias("yhat_upper")
    )
