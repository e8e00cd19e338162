"""From the three raw tables to the fact, as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast import schemas
from tillcast.functions.dates import iso_yearweek
from tillcast.operators.joins import join_calendar, join_prices
from tillcast.operators.reshape import melt_days
from tillcast.operators.windows import repair_price_weeks


def build_fact(sales_wide: DataFrame, calendar: DataFrame, prices: DataFrame) -> DataFrame:
    """Wide sales to rows, then the calendar, then the prices.

    The calendar (one row per day) is broadcast when Spark finds it small enough, so only the
    price join shuffles the rows.
    """
    schemas.require_columns(sales_wide, schemas.SALES_ID_COLUMNS)
    if "yearweek" not in calendar.columns:
        calendar = calendar.withColumn("yearweek", iso_yearweek(F.col("date")))
    long = melt_days(sales_wide, schemas.SALES_ID_COLUMNS)
    dated = join_calendar(long, calendar)
    return join_prices(dated, repair_price_weeks(prices)).select(*schemas.FACT.names)
