"""Shares, ranks, running values and row-to-row changes.

Ordered windows run over grouped rows (one per key and date or week), so a partition is as long
as the calendar whatever the number of fact rows. Totals over a partition that has no such bound
are grouped and joined back instead of being computed in a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.scalars import null_safe_match, safe_divide


def share_of_group(summary: DataFrame, within: list[str], measure: str, name: str) -> DataFrame:
    """Percentage of ``measure`` in its group. ``summary`` has one row per detail key.

    The group total is a second aggregate over the same exchange, joined back: a window would
    pull every detail row of a group into one task.
    """
    totals = summary.groupBy(*[F.col(c).alias(f"_{c}") for c in within]).agg(
        F.sum(measure).alias("_total")
    )
    on = null_safe_match([summary[c] for c in within], [totals[f"_{c}"] for c in within])
    joined = summary.join(totals, on)
    share = safe_divide(F.col(measure).cast("double"), F.col("_total").cast("double")) * 100
    return joined.select(*summary.columns, share.alias(name))


def rank_within(summary: DataFrame, within: list[str], measure: str, name: str) -> DataFrame:
    order = Window.partitionBy(*within).orderBy(F.desc(measure))
    return summary.withColumn(name, F.rank().over(order))


def top_n_per_group(summary: DataFrame, within: list[str], measure: str, tie: str, n: int):
    """The ``n`` largest rows of each group; Spark limits each task's rows before the shuffle."""
    order = Window.partitionBy(*within).orderBy(F.desc(measure), F.asc(tie))
    return summary.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def cumulative_by_date(rows: DataFrame, keys: list[str], date: str, value: str, name: str):
    """Running total per key for every input row; rows of one date share the value.

    The running sum is taken over daily totals and joined back to the rows, so no window holds
    the raw rows of a key.
    """
    daily = rows.groupBy(*keys, date).agg(F.sum(value).alias("_day"))
    order = Window.partitionBy(*keys).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    running = daily.select(
        *[F.col(c).alias(f"_{c}") for c in [*keys, date]], F.sum("_day").over(order).alias(name)
    )
    columns = [*keys, date]
    on = null_safe_match([rows[c] for c in columns], [running[f"_{c}"] for c in columns])
    return rows.join(running, on).select(*rows.columns, name)


def moving_average(daily: DataFrame, keys: list[str], date: str, value: str, n: int, name: str):
    """Mean of the current and up to ``n - 1`` previous rows."""
    order = Window.partitionBy(*keys).orderBy(date).rowsBetween(-(n - 1), 0)
    return daily.withColumn(name, F.avg(value).over(order))


def lag_change(summary: DataFrame, keys: list[str], order: str, value: str, name: str):
    """Percentage change to the previous row; NULL for the first row and after a zero."""
    previous = F.lag(value, 1, 0).over(Window.partitionBy(*keys).orderBy(order))
    change = (F.col(value) - previous).cast("double") * 100
    return summary.withColumn(name, safe_divide(change, previous.cast("double")))


def year_on_year(summary: DataFrame, keys: list[str], week: str, value: str, name: str):
    """Percentage change to the same ISO week a year earlier; NULL without such a week."""
    previous = summary.select(
        *[F.col(c).alias(f"_{c}") for c in keys],
        (F.col(week) + 100).alias("_week"),
        F.col(value).alias("_previous"),
    )
    on = null_safe_match([summary[c] for c in keys], [previous[f"_{c}"] for c in keys])
    joined = summary.join(previous, on & (summary[week] == previous["_week"]), "left")
    change = (F.col(value) - F.col("_previous")).cast("double") * 100
    return joined.select(
        *summary.columns, safe_divide(change, F.col("_previous").cast("double")).alias(name)
    )


def lags(df: DataFrame, keys: list[str], order: str, value: str, steps: list[int]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumns({f"lag_{k}": F.lag(value, k).over(w) for k in steps})


def rolling_stats(df: DataFrame, keys: list[str], order: str, value: str, n: int) -> DataFrame:
    """Mean and sample std of the last ``n`` rows; NULL until ``n`` values are there."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(n - 1), 0)
    full = F.count(value).over(w) == n
    return df.withColumns(
        {
            f"rolling_mean_{n}": F.when(full, F.avg(value).over(w)),
            f"rolling_std_{n}": F.when(full, F.stddev_samp(value).over(w)),
        }
    )


def pct_change(value: str, keys: list[str], order: str) -> Column:
    """Relative change to the previous row; NULL when that is missing or zero."""
    previous = F.lag(value).over(Window.partitionBy(*keys).orderBy(order))
    ratio = safe_divide(F.col(value).cast("double"), previous.cast("double"))
    return ratio - 1


def forward_fill(df: DataFrame, keys: list[str], order: list, value: str) -> DataFrame:
    """Last known value up to the current row."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(value, F.last(value, ignorenulls=True).over(w))


def monotone_weeks(df: DataFrame, keys: list[str], week: str = "yearweek") -> DataFrame:
    """Make ``week`` strictly increasing inside each key by raising repeated values.

    Each value becomes the larger of itself and the previous result plus one. In closed form
    that is the running maximum of (value - row number), plus the row number.
    """
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(week))
    row = F.row_number().over(order)
    numbered = df.withColumn("_row", row)
    upto = Window.partitionBy(*keys).orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    raised = F.max(F.col(week) - F.col("_row")).over(upto) + F.col("_row")
    return numbered.withColumn(week, raised.cast("int")).drop("_row")


def repair_price_weeks(prices: DataFrame) -> DataFrame:
    """Fill missing weeks with the previous one and make them increase per item, store and price."""
    keys = ["item", "store_code", "sell_price"]
    filled = forward_fill(prices, keys, [F.asc_nulls_last("yearweek")], "yearweek")
    return monotone_weeks(filled.withColumn("yearweek", F.col("yearweek").cast("int")), keys)


def duplicate_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with the number of rows after the first."""
    counted = df.groupBy(*keys).agg((F.count("*") - 1).alias("duplicates"))
    return counted.where(F.col("duplicates") > 0)
