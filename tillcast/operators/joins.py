"""Joins that build the fact and its event features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.scalars import exact_mean
from tillcast.sources.shared import materialise


#: Largest calendar that is broadcast: seven centuries of days, under 25 MB.
CALENDAR_ROWS = 250_000


def join_calendar(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Left join on the day label. The calendar, one row per day, is written once and counted;
    below the limit it is broadcast, so that the sales are not shuffled."""
    days = materialise(calendar.select("d", "yearweek", "date", "event"), "calendar")
    return sales.join(F.broadcast(days) if days.count() <= CALENDAR_ROWS else days, "d", "left")


def join_prices(sales: DataFrame, prices: DataFrame) -> DataFrame:
    """Left join on item, store and week; the price side's category is kept apart."""
    right = prices.withColumnRenamed("category", "category_price")
    return sales.join(right, ["item", "store_code", "yearweek"], "left")


def price_and_sales(fact: DataFrame) -> DataFrame:
    """Total sales and mean price per date and item in one aggregate instead of two and a join."""
    return fact.groupBy("date", "item").agg(
        F.sum("sales").alias("sales"), exact_mean(F.col("sell_price")).alias("sell_price")
    )


def monthly_with_regressors(monthly_sales: DataFrame, monthly_flags: DataFrame) -> DataFrame:
    return monthly_sales.join(monthly_flags, "date", "left")


def with_future_regressors(future: DataFrame, known: DataFrame, regressors: list[str], on: list[str]):
    """Known regressor values by date; 0 where none is known."""
    return future.join(known.select(*on, *regressors), on, "left").fillna(0, subset=regressors)


def flag_event_dates(df: DataFrame, event_dates: DataFrame, date: str = "date", name: str = "is_event"):
    """1 on the given dates, else 0. ``event_dates`` holds one row per event day."""
    marked = event_dates.select(F.col(date)).distinct().withColumn(name, F.lit(1))
    return df.join(marked, date, "left").fillna(0, subset=[name])


def expand_events(events: DataFrame) -> DataFrame:
    """One row per event and day of its window; ``offset`` counts from the event day."""
    days = F.sequence(F.col("lower_window"), F.col("upper_window"))
    return events.select("event", "ds", F.explode(days).alias("offset")).select(
        "event", F.date_add("ds", F.col("offset")).alias("ds"), "offset"
    )


def join_events(series: DataFrame, events: DataFrame) -> DataFrame:
    """Left join of a series with the windows of its events, one row per event that applies."""
    return series.join(expand_events(events), "ds", "left")


def event_flags(series: DataFrame, events: DataFrame, names: list[str]) -> DataFrame:
    """0/1 column per event name, 1 on every day inside one of its windows."""
    inside = expand_events(events).groupBy("ds").agg(
        *[F.max(F.when(F.col("event") == n, 1).otherwise(0)).alias(n) for n in names]
    )
    return series.join(inside, "ds", "left").fillna(0, subset=names)
