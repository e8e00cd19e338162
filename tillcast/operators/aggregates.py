"""Grouped measures, descriptions, histograms and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.scalars import exact_mean
from tillcast.operators.quantiles import exact_quantiles

_FUNCTIONS = {
    "sum": F.sum,
    "count": F.count,
    "avg": lambda c: exact_mean(F.col(c)),
    "min": F.min,
    "max": F.max,
    "std": F.stddev_samp,
}


def group_measures(df: DataFrame, by: list[str], **measures: tuple[str, str]) -> DataFrame:
    """``group_measures(df, ["store"], total=("sum", "sales"))``; ``std`` is the sample one."""
    columns = [_FUNCTIONS[f](c).alias(name) for name, (f, c) in measures.items()]
    return df.groupBy(*by).agg(*columns)


def correlation(df: DataFrame, by: list[str], a: str, b: str, name: str) -> DataFrame:
    return df.groupBy(*by).agg(F.corr(a, b).alias(name))


def describe(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max, per group or over everything."""
    moments = lambda v: [
        F.count(v).alias("count"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    ]
    return exact_quantiles(df, by or [], value, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, moments)


def price_profile(star, key: str) -> DataFrame:
    """Total sales, mean price and price spread (NULL to 0) per item or store."""
    profile = star.summarise(
        [key],
        total_sales=("sum", "sales"),
        average_price=("avg", "sell_price"),
        price_std=("std", "sell_price"),
    )
    return profile.fillna(0.0, subset=["price_std"])


def cluster_stats(df: DataFrame, features: list[str]) -> DataFrame:
    """One row per cluster: mean and sample std of each feature, two decimals, and the number of
    members. The members are the rows of ``df``; a list of them would have no bound."""
    columns = []
    for f in features:
        columns += [
            F.round(F.avg(f), 2).alias(f"{f}_mean"),
            F.round(F.stddev_samp(f), 2).alias(f"{f}_std"),
        ]
    return df.groupBy("cluster").agg(*columns, F.count("*").alias("members"))


def event_stats(by_year: DataFrame) -> DataFrame:
    """Mean and sample std of yearly event totals, two decimals, and the list of years.

    The input has one row per (year, event), so a group is as long as the calendar has years.
    """
    years = F.array_join(F.sort_array(F.collect_list(F.col("year").cast("string"))), ", ")
    return by_year.groupBy("event").agg(
        F.round(F.avg("total_sales"), 2).alias("mean_sales"),
        F.round(F.stddev_samp("total_sales"), 2).alias("std_sales"),
        years.alias("years"),
    )


def bin_index(value: str, low, high, bins: int):
    """Equal-width bin of a value; the highest value falls into the last bin."""
    width = (high - low) / F.lit(float(bins))
    position = F.floor((F.col(value) - low) / F.nullif(width, F.lit(0.0)))
    return F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int")


def assign_bins(df: DataFrame, value: str, bins: int, name: str = "bin") -> DataFrame:
    limits = df.agg(
        F.struct(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
    ).scalar()
    return df.withColumn(name, bin_index(value, limits["lo"], limits["hi"], bins))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    return assign_bins(df, value, bins).groupBy("bin").agg(F.count("*").alias("rows"))


def rollup_forecast(forecasts: DataFrame, dims: list[str]) -> DataFrame:
    """Total forecast per date and the dimensions among ``dims`` that the frame has."""
    present = [d for d in dims if d in forecasts.columns]
    return forecasts.groupBy("date", *present).agg(F.sum("forecast_sales").alias("forecast_sales"))


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def value_counts(df: DataFrame, column: str, n: int = 50) -> DataFrame:
    counted = df.groupBy(column).agg(F.count("*").alias("rows"))
    return counted.orderBy(F.desc("rows"), F.asc(column)).limit(n)
