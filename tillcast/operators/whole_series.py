"""Daily series as one row each: cleaning, splitting and calendar columns without a row for each day.

A row has the keys, ``first`` and ``last`` day, and the days with sales in order of time (``days``, with
their ``sold``); all days count from 1970. Days between them without sales are 0 and have no entry, except
the first one. A row is no longer than the calendar. Once the sold days of a series have met in one
exchange, later steps work on whole rows and need no other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions.dates import CHRISTMAS_FLAG_DAYS, HOLIDAY_FLAG_DAY, with_calendar_flags
from tillcast.operators.normal_equations import key_types

_FIELDS = "first int, last int, days array<int>, sold array<double>"
# Rows of a batch that are worked on, and given out, at once.
HELD_SERIES = 128
_BLOCK_DAYS, _HELD_BLOCKS = 1024, 64


def gathered(daily: DataFrame, keys: list[str], date: str = "date", value: str = "sales") -> DataFrame:
    """``days`` and ``sold`` of each series, in any order and as often as they come; NULL is 0. A row
    without a date adds nothing, but its series is listed."""
    day = F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))
    sold = F.coalesce(F.col(value), F.lit(0)).cast("double")
    entry = F.when(F.col(date).isNotNull(), F.struct(day.alias("day"), sold.alias("sold")))
    listed = daily.groupBy(*keys).agg(F.collect_list(entry).alias("_rows"))
    return listed.select(*keys, F.col("_rows")["day"].alias("days"), F.col("_rows")["sold"].alias("sold"))


def dense(first: int, last: int, days: np.ndarray, sold: np.ndarray) -> np.ndarray:
    """Every day's value; those of one day are added up."""
    at = np.asarray(days, dtype=np.int64) - first
    return np.bincount(at, weights=np.asarray(sold, dtype=float), minlength=last - first + 1)


def _cleaned(y: np.ndarray, threshold: float, deviations: float) -> tuple[int, np.ndarray] | None:
    """The series without outlier days, which become 0 or, at the ends, stay away; and the first
    day's place. None where more than the threshold is zeros."""
    if np.count_nonzero(y == 0) / len(y) > threshold:
        return None
    if len(y) < 2 or y.min() == y.max():
        return 0, y
    kept = np.abs((y - y.mean()) / y.std(ddof=1)) <= deviations
    places = np.flatnonzero(kept)
    if not len(places):
        return None
    return int(places[0]), np.where(kept, y, 0.0)[places[0] : places[-1] + 1]


def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start in range(0, len(batch), HELD_SERIES):
            yield batch.iloc[start : start + HELD_SERIES]


def cleaned(daily: DataFrame, keys: list[str], threshold: float = 0.9, deviations: float = 3.0) -> DataFrame:
    """All series of ``keys, date, sales``; those that are worth a model are ``kept``, and clean.

    The same as ``daily_series``, ``drop_mostly_zero``, ``drop_z_outliers`` and ``refill`` of
    :mod:`series`, with the empty days counted, not made.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in chunks(batches):
            records = []
            for days, sold in zip(batch["days"], batch["sold"]):
                found = None
                if len(days):
                    start = int(days.min())
                    found = _cleaned(dense(start, int(days.max()), days, sold), threshold, deviations)
                if found is None:
                    records.append((None, None, [], [], False))
                    continue
                first, y = start + found[0], found[1]
                at = np.flatnonzero(y)
                at = at if len(at) and at[0] == 0 else np.concatenate([[0], at])
                records.append((first, first + len(y) - 1, first + at, y[at], True))
            out = pd.DataFrame(records, columns=["first", "last", "days", "sold", "kept"], index=batch.index)
            yield pd.concat([batch[keys], out.astype({"first": "Int32", "last": "Int32"})], axis=1)

    rows = gathered(daily, keys)
    return rows.mapInPandas(run, f"{key_types(rows, keys)}, {_FIELDS}, kept boolean")


def upto(whole: DataFrame, last: Column) -> DataFrame:
    """The series up to a day; those that begin later are left out."""
    cut = whole.withColumn("_last", F.least(last, F.col("last"))).where(F.col("_last") >= F.col("first"))
    n = F.size(F.filter("days", lambda d: d <= F.col("_last")))
    kept = {c: F.slice(c, F.lit(1), n) for c in ("days", "sold")}
    return cut.withColumns(kept).withColumn("last", F.col("_last")).drop("_last")


def as_date(day: Column) -> Column:
    return F.date_from_unix_date(day)


def sold_days(whole: DataFrame, keys: list[str], *others: str) -> DataFrame:
    """``keys, ds, y`` and calendar flags of the days that have an entry."""
    entries = whole.select(*keys, *others, F.explode(F.arrays_zip("days", "sold")).alias("_e"))
    return with_calendar_flags(
        entries.select(*keys, *others, as_date(F.col("_e")["days"]).alias("ds"), F.col("_e")["sold"].alias("y"))
    )


def tail(days: int) -> Column:
    """Values of the last ``days`` days of a series, or of all it has, in order of time."""
    # No more entries than days can lie in the tail.
    begin, n = F.greatest(F.size("days") - days + 1, F.lit(1)), F.lit(days)
    entries = F.map_from_arrays(F.slice("days", begin, n), F.slice("sold", begin, n))
    start = F.greatest(F.col("first"), F.col("last") - days + 1)
    every = F.sequence(start, F.col("last"))
    return F.transform(every, lambda d: F.coalesce(F.try_element_at(entries, d), F.lit(0.0)))


def last_days(whole: DataFrame, keys: list[str], days: int) -> DataFrame:
    """``keys, ds, y`` and calendar flags of the last ``days`` days of each series, or all it has."""
    long = whole.withColumn("_tail", tail(days)).select(
        *keys, (F.col("last") - F.size("_tail") + 1).alias("_from"), F.posexplode("_tail").alias("_i", "y")
    )
    return with_calendar_flags(long.select(*keys, as_date(F.col("_from") + F.col("_i")).alias("ds"), "y"))


# --- in tasks --------------------------------------------------------------------------------


def flags(days: np.ndarray) -> dict[str, np.ndarray]:
    """The columns of ``dates.calendar_flags``."""
    date = days.astype("datetime64[D]")
    month = date.astype("datetime64[M]")
    december = month.astype(int) % 12 == 11
    day = (date - month).astype(int) + 1
    week_day = (days + 3) % 7
    return {
        "is_christmas": december & np.isin(day, CHRISTMAS_FLAG_DAYS),
        "is_holiday": december & (day == HOLIDAY_FLAG_DAY),
        "day_of_week": week_day,
        "is_weekend": week_day >= 5,
    }


class Calendar:
    """Columns that follow from the day alone, made once for all series of a task."""

    def __init__(self, columns: Callable[[np.ndarray], list[np.ndarray]]):
        self.columns, self.blocks = columns, {}

    def _block(self, i: int) -> np.ndarray:
        if i not in self.blocks:
            if len(self.blocks) >= _HELD_BLOCKS:
                self.blocks.clear()
            days = np.arange(i * _BLOCK_DAYS, (i + 1) * _BLOCK_DAYS)
            made = [np.asarray(c, dtype=float) for c in self.columns(days)]
            self.blocks[i] = np.stack(made, axis=1) if made else np.empty((_BLOCK_DAYS, 0))
        return self.blocks[i]

    def __call__(self, first: int, last: int) -> np.ndarray:
        """A row for each day from ``first`` to ``last``."""
        begin, end = first // _BLOCK_DAYS, last // _BLOCK_DAYS
        rows = np.concatenate([self._block(i) for i in range(begin, end + 1)])
        return rows[first - begin * _BLOCK_DAYS : last + 1 - begin * _BLOCK_DAYS]
