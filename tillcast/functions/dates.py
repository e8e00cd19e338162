"""Date expressions: ISO weeks, weekdays, calendar flags and named events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# December days around Christmas and their two naming rules.
CHRISTMAS_FLAG_DAYS = (23, 24, 26)
HOLIDAY_FLAG_DAY = 25
DECEMBER_EVENTS = {23: "Natal D-2", 24: "Natal D-1", 26: "Boxing Day"}
NATAL_YEARS = (2011, 2012, 2013, 2014, 2015, 2016)

# Days before and after an event that still belong to it.
EVENT_WINDOWS = {
    "SuperBowl": (0, 1),
    "Ramadan starts": (0, 1),
    "NewYear": (-1, 1),
    "Easter": (0, 1),
    "Thanksgiving": (-1, 1),
}

# Months of each season.
SEASON_MONTHS = {
    "summer": (6, 7, 8),
    "winter": (12, 1, 2),
    "fall": (9, 10, 11),
    "spring": (3, 4, 5),
}
ON_SEASON_MONTHS = (9, 10, 11, 12, 1)

FLAG_COLUMNS = ["is_christmas", "is_holiday", "day_of_week", "is_weekend"]


def iso_yearweek(date: Column) -> Column:
    """ISO year and week as one integer ``yyyyww``."""
    iso_year = F.date_part(F.lit("YEAROFWEEK"), date)
    return (iso_year * 100 + F.weekofyear(date)).cast("int")


def week_dates(yearweek: int) -> tuple[dt.date, dt.date]:
    """First and last date of an ISO week, so that a week filter can prune a scan by date."""
    first = dt.date.fromisocalendar(yearweek // 100, yearweek % 100, 1)
    return first, first + dt.timedelta(days=6)


def day_of_week(date: Column) -> Column:
    """Monday is 0."""
    return F.weekday(date)


def day_name(date: Column) -> Column:
    return F.date_format(date, "EEEE")


def week_ending_sunday(date: Column) -> Column:
    return F.date_add(F.date_trunc("week", date).cast("date"), 6)


def calendar_flags(date: Column) -> dict[str, Column]:
    december = F.month(date) == 12
    day = F.dayofmonth(date)
    return {
        "is_christmas": (december & day.isin(*CHRISTMAS_FLAG_DAYS)).cast("int"),
        "is_holiday": (december & (day == HOLIDAY_FLAG_DAY)).cast("int"),
        "day_of_week": day_of_week(date),
        "is_weekend": (day_of_week(date) >= 5).cast("int"),
    }


def with_calendar_flags(df: DataFrame, date: str = "ds") -> DataFrame:
    return df.withColumns(calendar_flags(F.col(date)))


def december_events(date: Column, event: Column) -> Column:
    """Name 23, 24 and 26 December; every other date keeps its event."""
    named = event
    for day, name in DECEMBER_EVENTS.items():
        hit = (F.month(date) == 12) & (F.dayofmonth(date) == day)
        named = F.when(hit, F.lit(name)).otherwise(named)
    return named


def natal_events(date: Column, event: Column, years=NATAL_YEARS) -> Column:
    """Name 25 December of the given years; every other date keeps its event."""
    hit = (F.month(date) == 12) & (F.dayofmonth(date) == 25) & F.year(date).isin(*years)
    return F.when(hit, F.lit("Natal")).otherwise(event)


def event_window(event: Column, windows: dict = EVENT_WINDOWS) -> tuple[Column, Column]:
    """``(lower_window, upper_window)`` of an event name; unknown names get ``(0, 0)``."""
    lower, upper = F.lit(0), F.lit(0)
    for name, (lo, hi) in windows.items():
        lower = F.when(event == name, F.lit(lo)).otherwise(lower)
        upper = F.when(event == name, F.lit(hi)).otherwise(upper)
    return lower, upper


def condition_columns(date: Column) -> dict[str, Column]:
    """Season flags, season by weekday/weekend flags, on/off season and quarter flags."""
    out: dict[str, Column] = {}
    weekend = day_of_week(date) >= 5
    for season, months in SEASON_MONTHS.items():
        inside = F.month(date).isin(*months)
        out[season] = inside.cast("int")
        out[f"{season}_weekday"] = (inside & ~weekend).cast("int")
        out[f"{season}_weekend"] = (inside & weekend).cast("int")
    on_season = F.month(date).isin(*ON_SEASON_MONTHS)
    out["on_season"] = on_season.cast("int")
    out["off_season"] = (~on_season).cast("int")
    for q in range(1, 5):
        out[f"quarter_{q}"] = (F.quarter(date) == q).cast("int")
    return out
