"""Forecast by the mean of each calendar cell.

Boosted trees on weekday, weekend and two December flags can only tell apart the combinations
those take (21 at most), so their limit is the mean of ``y`` per series and combination. That
is one aggregate. An unseen combination uses its weekday's mean, an unseen weekday the series'.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions.dates import CHRISTMAS_FLAG_DAYS, HOLIDAY_FLAG_DAY, calendar_flags
from tillcast.functions.scalars import clamp_non_negative

N_CELLS = 21
FLAGGED_DAYS = (*CHRISTMAS_FLAG_DAYS, HOLIDAY_FLAG_DAY)


def cell_code(dow: Column, christmas: Column, holiday: Column) -> Column:
    """0..20: weekday times three states of the December flags."""
    return (dow * 3 + christmas + 2 * holiday).cast("int")


def fit(train: DataFrame, keys: list[str], until: str | None = None) -> DataFrame:
    """One row per series. ``coefficients`` holds 21 cell means, 7 weekday means and the series
    mean; NULL where the training part has no such day.

    ``until`` names a column with the last day of the series' training part. ``train`` then needs rows
    only for its first day and for days with sales: all others up to ``until`` count as 0, by the
    calendar, without a row of their own.
    """
    code = cell_code(F.col("day_of_week"), F.col("is_christmas"), F.col("is_holiday"))
    cells = train.groupBy(*keys, code.alias("_code")).agg(
        F.sum("y").alias("_sum"),
        (F.count("y") if until is None else F.lit(0).cast("bigint")).alias("_n"),
        F.min("ds").alias("_first"),
        F.max("ds" if until is None else until).alias("_last"),
    )
    # At most 21 cells per series, side by side.
    placed = lambda c, i: F.max(F.when(F.col("_code") == i, F.col(c)))
    wide = cells.groupBy(*keys).agg(
        F.min("_first").alias("_first"),
        F.max("_last").alias("last_date"),
        *[placed(c, i).alias(f"{c}{i}") for c in ("_sum", "_n") for i in range(N_CELLS)],
    )
    # A cell without rows adds nothing.
    wide = wide.withColumns(
        {f"_sum{i}": F.when(F.col(f"_n{i}").isNull(), 0.0).otherwise(F.col(f"_sum{i}")) for i in range(N_CELLS)}
    )
    if until is not None:
        wide = wide.withColumn("_flagged", _flagged_codes(F.col("_first"), F.col("last_date")))
        wide = wide.withColumns(_calendar_counts(F.col("_first"), F.col("last_date"), F.col("_flagged")))
    exact = [_mean([i]) for i in range(N_CELLS)]
    weekday = [_mean([3 * d, 3 * d + 1, 3 * d + 2]) for d in range(7)]
    coefficients = F.array(*exact, *weekday, _mean(list(range(N_CELLS))))
    return wide.select(*keys, coefficients.alias("coefficients"), "last_date")


def _flagged_codes(first: Column, last: Column) -> Column:
    """Cells of the flagged December days from ``first`` to ``last``."""
    december = F.flatten(
        F.transform(
            F.sequence(F.year(first), F.year(last)),
            lambda y: F.array(*[F.make_date(y, F.lit(12), F.lit(d)) for d in FLAGGED_DAYS]),
        )
    )

    def code_of(day: Column) -> Column:
        flags = calendar_flags(day)
        return cell_code(flags["day_of_week"], flags["is_christmas"], flags["is_holiday"])

    return F.transform(F.filter(december, lambda d: d.between(first, last)), code_of)


def _calendar_counts(first: Column, last: Column, flagged: Column) -> dict[str, Column]:
    """Number of days from ``first`` to ``last`` in each cell."""

    def weeks(date: Column, day: int) -> Column:
        # Weeks begun on that weekday up to a date; 1970-01-01 was a Thursday, day 3.
        return F.floor((F.unix_date(date) + 3 - day) / 7)

    counts = {}
    for day in range(7):
        special = [F.size(flagged) - F.size(F.array_remove(flagged, 3 * day + i)) for i in (1, 2)]
        plain = weeks(last, day) - weeks(F.date_sub(first, 1), day) - special[0] - special[1]
        counts |= {f"_n{3 * day + i}": n.cast("bigint") for i, n in enumerate([plain, *special])}
    return counts


def _mean(codes: list[int]) -> Column:
    """Mean of ``y`` over some cells, NULL without any."""
    total = sum((F.col(f"_sum{i}") for i in codes), F.lit(0.0))
    rows = sum((F.coalesce(f"_n{i}", F.lit(0)) for i in codes), F.lit(0).cast("bigint"))
    return total / F.nullif(rows, F.lit(0))


def predicted(coefficients: Column) -> Column:
    code = cell_code(F.col("day_of_week"), F.col("is_christmas"), F.col("is_holiday"))
    weekday = coefficients[F.lit(N_CELLS) + F.col("day_of_week")]
    return clamp_non_negative(F.coalesce(coefficients[code], weekday, coefficients[N_CELLS + 7]))


def score(frame: DataFrame, models: DataFrame, keys: list[str]) -> DataFrame:
    joined = frame.join(models.select(*keys, "coefficients"), keys)
    return joined.withColumn("yhat", predicted(F.col("coefficients"))).drop("coefficients")
