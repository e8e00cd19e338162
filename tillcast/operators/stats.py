"""Elasticity, correlation, decomposition, stationarity and autocorrelation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.dates import day_of_week
from tillcast.functions.scalars import safe_divide
from tillcast.operators import joins, windows

# Fixed value: 5 % critical value of the Dickey-Fuller test with a constant.
DICKEY_FULLER_5PCT = -2.86


def price_elasticity(price_sales: DataFrame) -> DataFrame:
    """Per item and day: relative change of sales over relative change of price, for all items.

    NULL where the price did not change. The input has one row per (date, item).
    """
    changes = price_sales.select(
        "item",
        "date",
        windows.pct_change("sales", ["item"], "date").alias("sales_pct_change"),
        windows.pct_change("sell_price", ["item"], "date").alias("price_pct_change"),
    ).dropna()
    ratio = safe_divide(F.col("sales_pct_change"), F.col("price_pct_change"))
    return changes.withColumn("elasticity", ratio)


def mean_elasticity(price_sales: DataFrame) -> DataFrame:
    return price_elasticity(price_sales).groupBy("item").agg(F.avg("elasticity").alias("elasticity"))


def correlation_matrix(totals: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """Correlation of the daily totals of every two keys ``a <= b``, in rows; for an attribute with few
    values.

    ``totals`` has one row per key and day; a day without a row counts as 0, which needs no rows
    of its own: sums over the rows there are and the number of days are enough. The sums are
    exact integers. NULL where one of the two doesn't vary.
    """
    left = totals.select(F.col(day).alias("_day"), F.col(key).alias("a"), F.col(value).alias("_x"))
    right = totals.select(F.col(day).alias("_day"), F.col(key).alias("b"), F.col(value).alias("_y"))
    exact = "decimal(38,0)"
    products = (
        left.join(right, "_day")
        .where("a <= b")
        .groupBy("a", "b")
        .agg(F.sum((F.col("_x") * F.col("_y")).cast(exact)).alias("_xy"))
    )
    own = totals.groupBy(F.col(key).alias("a")).agg(
        F.sum(F.col(value).cast(exact)).alias("_sx"),
        F.sum((F.col(value) * F.col(value)).cast(exact)).alias("_sxx"),
    )
    other = own.select(F.col("a").alias("b"), F.col("_sx").alias("_sy"), F.col("_sxx").alias("_syy"))
    days = totals.select(day).distinct().agg(F.count("*").alias("_n"))
    # Two keys without a common day have no products, but a correlation.
    pairs = own.join(other, F.col("a") <= F.col("b")).join(products, ["a", "b"], "left")
    joined = pairs.fillna(0, ["_xy"]).join(F.broadcast(days))
    n, sx, sy = F.col("_n").cast("double"), F.col("_sx").cast("double"), F.col("_sy").cast("double")
    cov = n * F.col("_xy").cast("double") - sx * sy
    spread = (n * F.col("_sxx").cast("double") - sx * sx) * (n * F.col("_syy").cast("double") - sy * sy)
    return joined.select("a", "b", F.when(spread > 0, cov / F.sqrt(spread)).alias("corr"))


def decompose(series: DataFrame, keys: list[str]) -> DataFrame:
    """Additive decomposition of a dense daily series with period 7.

    Trend: centred mean of 7 days, NULL in the first and last three. Season: mean of
    (y - trend) per weekday, shifted to mean 0. Residual: what remains.
    """
    centred = Window.partitionBy(*keys).orderBy("ds").rowsBetween(-3, 3)
    full = F.count("y").over(centred) == 7
    trend = series.withColumn("trend", F.when(full, F.avg("y").over(centred)))
    trend = trend.withColumn("_phase", day_of_week(F.col("ds")))
    phases = trend.groupBy(*keys, "_phase").agg(F.avg(F.col("y") - F.col("trend")).alias("_mean"))
    grand = F.avg("_mean").over(Window.partitionBy(*keys))
    phases = phases.select(*keys, "_phase", (F.col("_mean") - grand).alias("seasonal"))
    joined = trend.join(phases, [*keys, "_phase"]).drop("_phase")
    return joined.withColumn("resid", F.col("y") - F.col("trend") - F.col("seasonal"))


def daily_features(series: DataFrame, keys: list[str], event_days: DataFrame) -> DataFrame:
    """Weekday, month, lags 1 and 7, rolling mean and std of 7 days, event flag; complete rows."""
    df = series.select(*keys, "ds", "y").withColumns(
        {"day_of_week": day_of_week(F.col("ds")), "month": F.month("ds")}
    )
    df = windows.lags(df, keys, "ds", "y", [1, 7])
    df = windows.rolling_stats(df, keys, "ds", "y", 7)
    df = joins.flag_event_dates(df, event_days.withColumnRenamed("date", "ds"), "ds")
    return df.dropna()


def stationarity(series: DataFrame, keys: list[str]) -> DataFrame:
    """Dickey-Fuller t statistic per series and the number of differences it suggests.

    Regression of the daily change on the previous value with a constant and no further lags.
    """
    previous = F.lag("y").over(Window.partitionBy(*keys).orderBy("ds"))
    changes = series.select(*keys, previous.alias("_x"), (F.col("y") - previous).alias("_dy"))
    sums = changes.where(F.col("_x").isNotNull()).groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.regr_sxx("_dy", "_x").alias("_sxx"),
        F.regr_syy("_dy", "_x").alias("_syy"),
        F.regr_sxy("_dy", "_x").alias("_sxy"),
    )
    slope = safe_divide(F.col("_sxy"), F.col("_sxx"))
    rest = (F.col("_syy") - slope * F.col("_sxy")) / F.nullif(F.col("n") - 2, F.lit(0))
    t = safe_divide(slope, F.sqrt(safe_divide(F.greatest(rest, F.lit(0.0)), F.col("_sxx"))))
    stationary = F.col("df_statistic") < DICKEY_FULLER_5PCT
    return sums.select(*keys, "n", t.alias("df_statistic")).withColumn(
        "suggested_d", F.when(stationary, 0).otherwise(1)
    )


def residuals(forecasts: DataFrame, actual: str = "y", predicted: str = "yhat") -> DataFrame:
    return forecasts.withColumn("residual", F.col(actual) - F.col(predicted))


def autocorrelation(series: DataFrame, keys: list[str], value: str, max_lag: int) -> DataFrame:
    """Autocorrelation per series and lag 1..max_lag.

    Every row meets its ``max_lag`` predecessors inside the window, and the products are summed
    on the map side.
    """
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("ds").rowsBetween(-max_lag, -1)
    centred = series.withColumn("_e", F.col(value) - F.avg(value).over(whole))
    lagged = centred.select(
        *keys,
        "_e",
        F.sum(F.col("_e") * F.col("_e")).over(whole).alias("_total"),
        F.reverse(F.collect_list("_e").over(before)).alias("_previous"),
    ).select(*keys, "_e", "_total", F.posexplode("_previous").alias("_pos", "_before"))
    products = F.sum(F.col("_e") * F.col("_before"))
    return lagged.groupBy(*keys, (F.col("_pos") + 1).alias("lag")).agg(
        safe_divide(products, F.max("_total")).alias("acf")
    )
