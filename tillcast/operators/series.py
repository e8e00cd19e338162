"""Daily series: building, cleaning, splitting and feature columns, for all series at once.

A series frame has key columns, ``ds`` and ``y``. Every step works per key on rows ordered by
``ds``; after the first step the rows are hash-partitioned and sorted by key, and the later
windows reuse that. A series is as long as the calendar, so a window partition stays small even
for a key that holds a third of all fact rows: the rows are summed per day before the shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.dates import week_ending_sunday, with_calendar_flags

EPOCH = "1970-01-01"


def _ordered(keys: list[str], ds: str = "ds"):
    return Window.partitionBy(*keys).orderBy(ds)


def _whole(keys: list[str]):
    return Window.partitionBy(*keys)


def _whole_in_order(keys: list[str]):
    """All rows of a series, on the order that :func:`densify` needs as well: one sort serves both."""
    return _ordered(keys).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


# --- building --------------------------------------------------------------------------------


def densify(
    df: DataFrame,
    keys: list[str],
    ds: str,
    fills: dict[str, Column],
    step_days: int = 1,
    position: str | None = None,
    since: Column | None = None,
) -> DataFrame:
    """Add the missing dates between the first and last date of each key.

    Each row generates the dates up to the next row, so there is no table of all dates and no
    join. ``fills`` gives column values on added dates; other columns repeat the row before
    the gap. ``position`` names a column counting the steps since the last given row. ``since``, for
    steps of a day, is the first date to come out; days before it are never made.
    """
    following = F.lead(ds).over(_ordered(keys, ds))
    upto = F.coalesce(F.date_sub(following, 1), F.col(ds))
    days = F.sequence(F.col(ds), upto, F.expr(f"interval {step_days} day"))
    others = [c for c in df.columns if c != ds]
    if since is None:
        long = df.withColumn("_days", days).select(*others, F.posexplode("_days").alias("_pos", ds))
    else:
        start = F.greatest(F.col(ds), since)
        kept = df.withColumns({"_upto": upto, "_start": start}).where(F.col("_start") <= F.col("_upto"))
        ahead = F.posexplode(F.sequence("_start", "_upto")).alias("_ahead", "_day")
        long = kept.select(*others, F.datediff("_start", ds).alias("_skipped"), ahead)
        long = long.withColumn("_pos", F.col("_skipped") + F.col("_ahead")).withColumnRenamed("_day", ds)
    for column, fill in fills.items():
        long = long.withColumn(column, F.when(F.col("_pos") > 0, fill).otherwise(F.col(column)))
    long = long.withColumnRenamed("_pos", position) if position else long.drop("_pos")
    return long.select(*df.columns, *([position] if position else []))


def daily_totals(
    rows: DataFrame, keys: list[str], date: str = "date", value: str = "sales", grouped: bool = False
) -> DataFrame:
    """Sum per day (NULL as 0) of the days that have rows. With ``grouped`` no two rows have the same
    keys and date, and none are grouped again, which would hold each of them once more."""
    if grouped:
        y = F.coalesce(F.col(value), F.lit(0)).cast("double")
        return rows.select(*keys, F.col(date).alias("ds"), y.alias("y"))
    return rows.groupBy(*keys, F.col(date).alias("ds")).agg(
        F.sum(F.coalesce(F.col(value), F.lit(0))).cast("double").alias("y")
    )


def last_day(keys: list[str]) -> Column:
    return F.max("ds").over(_whole_in_order(keys))


def daily_series(
    rows: DataFrame,
    keys: list[str],
    date: str = "date",
    value: str = "sales",
    log: bool = False,
    flags: bool = True,
    tail: int | None = None,
    grouped: bool = False,
) -> DataFrame:
    """Sum per day (NULL as 0), dense from first to last day with 0 in the gaps, plus flags.

    With ``tail`` only the last so many days of each series are made; ``grouped`` is that of
    :func:`daily_totals`.
    """
    daily = daily_totals(rows, keys, date, value, grouped)
    since = None if tail is None else F.date_sub(last_day(keys), tail - 1)
    dense = densify(daily, keys, "ds", {"y": F.lit(0.0)}, since=since)
    if log:
        dense = dense.withColumn("y", F.log1p("y"))
    return with_calendar_flags(dense) if flags else dense


def weekly_series(rows: DataFrame, keys: list[str], date: str = "date", value: str = "sales"):
    """Sum per week ending on Sunday, weeks without rows as 0; flags say if any day had them."""
    flagged = with_calendar_flags(rows.select(*keys, F.col(date).alias("_day"), value), "_day")
    weekly = flagged.groupBy(*keys, week_ending_sunday(F.col("_day")).alias("ds")).agg(
        F.sum(F.coalesce(F.col(value), F.lit(0))).cast("double").alias("y"),
        F.max("is_christmas").alias("is_christmas"),
        F.max("is_holiday").alias("is_holiday"),
    )
    empty = {"y": F.lit(0.0), "is_christmas": F.lit(0), "is_holiday": F.lit(0)}
    return densify(weekly, keys, "ds", empty, step_days=7)


def monthly_series(rows: DataFrame, keys: list[str], date: str = "date", value: str = "sales"):
    """Totals per month end, with the number of flagged days that have rows."""
    daily = rows.groupBy(*keys, F.col(date).alias("_day")).agg(F.sum(value).alias("_y"))
    return (
        with_calendar_flags(daily, "_day")
        .groupBy(*keys, F.last_day("_day").alias("ds"))
        .agg(
            F.sum("_y").cast("double").alias("y"),
            F.sum("is_christmas").alias("is_christmas"),
            F.sum("is_holiday").alias("is_holiday"),
            F.sum("is_weekend").alias("is_weekend"),
        )
    )


def missing_dates(present: DataFrame, keys: list[str], date: str) -> DataFrame:
    """Dates between the first and last of each key that have no row."""
    dense = densify(present.select(*keys, date), keys, date, {}, position="_gap")
    return dense.where(F.col("_gap") > 0).drop("_gap")


# --- filters ---------------------------------------------------------------------------------


def zero_ratio(series: DataFrame, keys: list[str]) -> DataFrame:
    return series.groupBy(*keys).agg(F.avg((F.col("y") == 0).cast("double")).alias("zero_ratio"))


def empty_share(keys: list[str]) -> Column:
    """Share of zero days from the first to the last day of a series, from daily totals whose empty
    days have no rows: the same as :func:`zero_ratio` of the dense series, without making it."""
    w = _whole_in_order(keys)
    days = F.datediff(F.max("ds").over(w), F.min("ds").over(w)) + 1
    sold = F.count_if((F.col("y") != 0) & F.col("ds").isNotNull()).over(w)
    return (days - sold) / days


def drop_mostly_zero(series: DataFrame, keys: list[str], threshold: float = 0.9) -> DataFrame:
    """Drop series whose share of zero days is strictly above the threshold."""
    share = F.avg((F.col("y") == 0).cast("double")).over(_whole(keys))
    return series.withColumn("_zero", share).where(F.col("_zero") <= threshold).drop("_zero")


def length_status(series: DataFrame, keys: list[str], test_days: int) -> DataFrame:
    """One row per series: lengths of the split and why the series would be skipped, if so."""
    split = split_tail_days(series, keys, test_days)
    counted = split.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "test").alias("n_test"),
    )
    status = (
        F.when(F.col("n") < test_days + 1, "too short")
        .when((F.col("n_train") < 2) | (F.col("n_test") < 1), "split too short")
        .otherwise("ok")
    )
    return counted.withColumn("status", status)


# --- outliers --------------------------------------------------------------------------------


def with_z_score(series: DataFrame, keys: list[str]) -> DataFrame:
    """Distance from the series mean in sample standard deviations; NULL when that is 0."""
    w = _whole(keys)
    deviation = F.nullif(F.stddev_samp("y").over(w), F.lit(0.0))
    return series.withColumn("z", (F.col("y") - F.avg("y").over(w)) / deviation)


def z_outliers(series: DataFrame, keys: list[str], threshold: float = 3.0) -> DataFrame:
    """Rows further than ``threshold`` deviations from the mean, with their score."""
    return with_z_score(series, keys).where(F.abs("z") > threshold)


def drop_z_outliers(series: DataFrame, keys: list[str], threshold: float = 3.0) -> DataFrame:
    scored = with_z_score(series, keys)
    return scored.where(F.col("z").isNull() | (F.abs("z") <= threshold)).drop("z")


def with_iqr_bounds(series: DataFrame, keys: list[str], factor: float = 1.5) -> DataFrame:
    w = _whole(keys)
    quartiles = F.percentile("y", F.array(F.lit(0.25), F.lit(0.75))).over(w)
    spread = F.col("_q")[1] - F.col("_q")[0]
    return (
        series.withColumn("_q", quartiles)
        .withColumn("iqr_low", F.col("_q")[0] - factor * spread)
        .withColumn("iqr_high", F.col("_q")[1] + factor * spread)
        .drop("_q")
    )


def iqr_outliers(series: DataFrame, keys: list[str], factor: float = 1.5) -> DataFrame:
    bounded = with_iqr_bounds(series, keys, factor)
    return bounded.where(~F.col("y").between(F.col("iqr_low"), F.col("iqr_high")))


def drop_iqr_outliers(series: DataFrame, keys: list[str], factor: float = 1.5) -> DataFrame:
    bounded = with_iqr_bounds(series, keys, factor)
    inside = F.col("y").between(F.col("iqr_low"), F.col("iqr_high"))
    return bounded.where(inside).drop("iqr_low", "iqr_high")


def refill(series: DataFrame, keys: list[str], mode: str = "zero") -> DataFrame:
    """Make a cleaned series dense again. Dropped days become 0, or lie on the line between
    their neighbours with ``mode="interpolate"``; dropped first or last days stay away."""
    frame = series.select(*keys, "ds", "y")
    if mode == "zero":
        return with_calendar_flags(densify(frame, keys, "ds", {"y": F.lit(0.0)}))
    w = _ordered(keys)
    frame = frame.withColumns({"_next": F.lead("y").over(w), "_to": F.lead("ds").over(w), "_from": F.col("ds")})
    line = F.col("y") + (F.col("_next") - F.col("y")) * F.col("_k") / F.datediff("_to", "_from")
    dense = densify(frame, keys, "ds", {}, position="_k")
    dense = dense.withColumn("y", F.when(F.col("_k") > 0, line).otherwise(F.col("y")))
    return with_calendar_flags(dense.select(*keys, "ds", "y"))


def impute_gaps(observed: DataFrame, keys: list[str], limit: int = 5, window: int = 7) -> DataFrame:
    """Fill missing days: gaps of up to ``limit`` days linearly, longer ones with the mean of
    the ``window`` observed values before the gap."""
    w = _ordered(keys)
    frame = observed.select(*keys, "ds", "y").withColumns(
        {
            "_next": F.lead("y").over(w),
            "_gap": F.datediff(F.lead("ds").over(w), F.col("ds")) - 1,
            "_mean": F.avg("y").over(w.rowsBetween(-(window - 1), 0)),
        }
    )
    dense = densify(frame, keys, "ds", {}, position="_k")
    line = F.col("y") + (F.col("_next") - F.col("y")) * F.col("_k") / (F.col("_gap") + 1)
    filled = F.when(F.col("_k") == 0, F.col("y")).when(F.col("_gap") <= limit, line).otherwise(F.col("_mean"))
    return dense.select(*keys, "ds", filled.alias("y"), (F.col("_k") > 0).cast("int").alias("imputed"))


# --- splits and folds ------------------------------------------------------------------------


def split_tail_days(series: DataFrame, keys: list[str], days: int, last: str | None = None) -> DataFrame:
    """``test`` is the last ``days`` days of each series, whose last day ``last`` may name."""
    cutoff = F.date_sub(F.max("ds").over(_whole(keys)) if last is None else F.col(last), days)
    return series.withColumn("split", F.when(F.col("ds") <= cutoff, "train").otherwise("test"))


def numbered(series: DataFrame, keys: list[str]) -> DataFrame:
    """``_row`` counts the rows of a series from 1 in order of time, ``_rows`` is their number."""
    return series.withColumns(
        {
            "_row": F.row_number().over(_ordered(keys)),
            "_rows": F.count("*").over(_whole(keys)).cast("int"),
        }
    )


def split_fraction(series: DataFrame, keys: list[str], train: float, local: bool = True) -> DataFrame:
    """First share of the rows of each series, or of the time all series span, as ``train``."""
    if local:
        inside = F.col("_row") <= F.floor(F.col("_rows") * F.lit(train))
        placed = numbered(series, keys)
        return placed.withColumn("split", F.when(inside, "train").otherwise("test")).drop("_row", "_rows")
    span = series.agg(F.struct(F.min("ds").alias("lo"), F.max("ds").alias("hi"))).scalar()
    days = F.floor((F.datediff(span["hi"], span["lo"]) + 1) * F.lit(train)).cast("int")
    inside = F.datediff(F.col("ds"), span["lo"]) < days
    return series.withColumn("split", F.when(inside, "train").otherwise("test"))


def split_year(series: DataFrame, year: int) -> DataFrame:
    split = F.when(F.year("ds") < year, "train").when(F.year("ds") == year, "test")
    return series.withColumn("split", split).where(F.col("split").isNotNull())


def split_three_way(series: DataFrame, keys: list[str], valid: float, test: float) -> DataFrame:
    """Cut the test share off the end, then the validation share off the end of the rest."""
    fit = F.floor(F.col("_rows") * F.lit(1.0 - test))
    train = F.floor(fit * F.lit(1.0 - valid))
    split = F.when(F.col("_row") <= train, "train").when(F.col("_row") <= fit, "valid").otherwise("test")
    return numbered(series, keys).withColumn("split", split).drop("_row", "_rows")


def _folds(series: DataFrame, keys: list[str], bounds: list[tuple[int, Column, Column]]) -> DataFrame:
    """Rows of every fold: train up to the first bound, test up to the second."""
    structs = [
        F.struct(F.lit(i).alias("fold"), a.cast("int").alias("_after"), b.cast("int").alias("_upto"))
        for i, a, b in bounds
    ]
    exploded = numbered(series, keys).select(*series.columns, "_row", F.explode(F.array(*structs)).alias("_f"))
    used = exploded.select(*series.columns, "_row", "_f.*").where(F.col("_row") <= F.col("_upto"))
    split = F.when(F.col("_row") <= F.col("_after"), "train").otherwise("test")
    return used.withColumn("split", split).drop("_row", "_after", "_upto")


def folds_expanding(series: DataFrame, keys: list[str], k: int = 5) -> DataFrame:
    """``k`` growing training sets, each followed by a test set of ``rows // (k + 1)`` rows."""
    size = F.floor(F.col("_rows") / (k + 1))
    bounds = []
    for i in range(1, k + 1):
        end = F.col("_rows") - size * (k - i)
        bounds.append((i, end - size, end))
    return _folds(series, keys, bounds)


def _rolling_bounds(rows: Column, k: int, fold_pct: float, overlap_pct: float, label=lambda j: j):
    size = F.floor(rows * F.lit(fold_pct))
    step = size - F.floor(size * F.lit(overlap_pct))
    bounds = []
    for i in range(1, k + 1):
        end = rows - step * (k - i)
        bounds.append((label(i), end - size, end))
    return bounds


def folds_rolling_origin(series, keys, k: int = 5, fold_pct: float = 0.1, overlap_pct: float = 0.5):
    """``k`` folds whose test sets hold ``fold_pct`` of the rows and overlap by ``overlap_pct``;
    the last one ends with the data."""
    return _folds(series, keys, _rolling_bounds(F.col("_rows"), k, fold_pct, overlap_pct))


def folds_double(series, keys, k: int = 5, valid_pct: float = 0.1, test_pct: float = 0.1) -> DataFrame:
    """Test folds at the end of the data and validation folds before them; ``kind`` tells which."""
    test = _rolling_bounds(F.col("_rows"), k, test_pct / k, 0.0)
    rest = test[0][1]
    valid = _rolling_bounds(rest, k, valid_pct / k, 0.0, label=lambda j: -j)
    folds = _folds(series, keys, test + valid)
    kind = F.when(F.col("fold") > 0, "test").otherwise("valid")
    return folds.withColumn("kind", kind).withColumn("fold", F.abs("fold"))


def horizon_cutoffs(series: DataFrame, keys: list[str], initial: int, period: int, horizon: int):
    """Cutoff dates per series: every ``period`` days back from ``horizon`` days before the end,
    as long as ``initial`` days of training data remain."""
    span = series.groupBy(*keys).agg(F.min("ds").alias("_lo"), F.max("ds").alias("_hi"))
    latest, earliest = F.date_sub("_hi", horizon), F.date_add("_lo", initial)
    cutoffs = F.sequence(latest, earliest, F.expr(f"interval -{period} day"))
    return span.where(latest >= earliest).select(*keys, F.explode(cutoffs).alias("cutoff"))


def folds_horizon(series: DataFrame, keys: list[str], initial=365, period=30, horizon=30) -> DataFrame:
    """Rows of each cutoff: train up to it, test in the following ``horizon`` days."""
    w = _whole(keys)
    latest = F.date_sub(F.max("ds").over(w), horizon)
    earliest = F.date_add(F.min("ds").over(w), initial)
    spanned = series.withColumns({"_latest": latest, "_earliest": earliest})
    spanned = spanned.where(F.col("_latest") >= F.col("_earliest"))
    # A row serves a cutoff if it lies at most `horizon` days after it.
    needed = F.greatest(F.col("_earliest"), F.date_sub("ds", horizon))
    behind = F.floor(F.datediff(F.col("_latest"), needed) / period).cast("int")
    steps = F.when(behind >= 0, F.sequence(F.lit(0), behind))
    rows = spanned.select(*series.columns, "_latest", F.explode(steps).alias("_s"))
    cutoff = F.date_sub(F.col("_latest"), (F.col("_s") * period).cast("int"))
    split = F.when(F.col("ds") <= F.col("cutoff"), "train").otherwise("test")
    return rows.withColumn("cutoff", cutoff).withColumn("split", split).drop("_latest", "_s")


# --- frames and features ---------------------------------------------------------------------


def future_frame(series: DataFrame, keys: list[str], periods: int, step: str = "day", history=False):
    """The next ``periods`` dates of each series with calendar flags; optionally its history."""
    last = series.groupBy(*keys).agg(F.max("ds").alias("_last"))
    steps = last.select(*keys, "_last", F.explode(F.sequence(F.lit(1), F.lit(periods))).alias("_i"))
    dates = {
        "day": F.date_add("_last", F.col("_i")),
        "week": F.date_add("_last", F.col("_i") * 7),
        "month": F.last_day(F.add_months("_last", F.col("_i"))),
    }
    future = steps.select(*keys, dates[step].alias("ds"))
    if history:
        future = series.select(*keys, "ds").unionByName(future)
    return with_calendar_flags(future)


def infer_step(observed: DataFrame, keys: list[str], ds: str = "ds") -> DataFrame:
    """Most frequent distance between neighbouring dates (the smaller one on a tie)."""
    gaps = observed.select(*keys, F.datediff(F.col(ds), F.lag(ds).over(_ordered(keys, ds))).alias("step_days"))
    counted = gaps.where(F.col("step_days").isNotNull()).groupBy(*keys, "step_days").agg(F.count("*").alias("_n"))
    best = F.min_by("step_days", F.struct(-F.col("_n"), F.col("step_days")))
    found = counted.groupBy(*keys).agg(best.alias("step_days"))
    return found.withColumn("is_daily", F.col("step_days") == 1)


def auto_seasonality(observed: DataFrame, keys: list[str], ds: str = "ds") -> DataFrame:
    """Which seasons to switch on: sampled finer than the period, and two periods present."""
    span = observed.groupBy(*keys).agg((F.datediff(F.max(ds), F.min(ds)) + 1).alias("span_days"))
    steps = infer_step(observed, keys, ds).drop("is_daily")
    joined = span.join(steps, keys) if keys else span.crossJoin(steps)
    on = lambda period: (F.col("step_days") < period) & (F.col("span_days") >= 2 * period)
    return joined.withColumns({"yearly": on(365), "weekly": on(7), "daily": on(1)})


def lag_matrix(series: DataFrame, keys: list[str], n_lags: int, regressors: dict[str, int] | None = None):
    """Lags 1..n of ``y`` and of each regressor; rows without all lags are dropped."""
    w = _ordered(keys)
    columns = {f"y_lag_{k}": F.lag("y", k).over(w) for k in range(1, n_lags + 1)}
    for name, n in (regressors or {}).items():
        columns |= {f"{name}_lag_{k}": F.lag(name, k).over(w) for k in range(1, n + 1)}
    return series.withColumns(columns).dropna(subset=list(columns))


def normalise(series: DataFrame, keys: list[str], method: str = "minmax", local: bool = True) -> DataFrame:
    """Min-max (default) or z-score values per series, or with statistics over all series."""
    stats = {"lo": F.min("y"), "hi": F.max("y"), "mean": F.avg("y"), "std": F.stddev_samp("y")}
    if local:
        value = {k: v.over(_whole(keys)) for k, v in stats.items()}
    else:
        # One row for all series, joined back.
        series = series.join(F.broadcast(series.agg(*[v.alias(f"_{k}") for k, v in stats.items()])))
        value = {k: F.col(f"_{k}") for k in stats}
    if method == "minmax":
        scaled = (F.col("y") - value["lo"]) / F.nullif(value["hi"] - value["lo"], F.lit(0.0))
    else:
        scaled = (F.col("y") - value["mean"]) / F.nullif(value["std"], F.lit(0.0))
    return series.withColumn("y_norm", scaled).drop(*[f"_{k}" for k in stats])


def fourier(ds: Column, period: float, order: int, condition: Column | None = None) -> list[Column]:
    """sin and cos terms 1..order of a season, in days since 1970; 0 outside the condition."""
    day = F.datediff(ds, F.lit(EPOCH).cast("date"))
    terms = []
    for k in range(1, order + 1):
        angle = day * F.lit(2.0 * math.pi * k / period)
        terms += [F.sin(angle), F.cos(angle)]
    return terms if condition is None else [t * condition for t in terms]


def changepoints(n: int = 10, share: float = 0.8) -> list[float]:
    """Positions of ``n`` changepoints, evenly spaced in the first ``share`` of scaled time."""
    return [share * j / (n + 1) for j in range(1, n + 1)]


def trend_basis(t: Column, n: int = 10, share: float = 0.8) -> list[Column]:
    """Hinges of a piecewise-linear trend over scaled time ``t`` (0 at start, 1 at train end)."""
    return [F.greatest(F.lit(0.0), t - F.lit(c)) for c in changepoints(n, share)]


def scaled_time(keys: list[str]) -> Column:
    """0 on the first day of a series and 1 on the last."""
    w = _whole(keys)
    span = F.nullif(F.datediff(F.max("ds").over(w), F.min("ds").over(w)), F.lit(0))
    return F.coalesce(F.datediff(F.col("ds"), F.min("ds").over(w)) / span, F.lit(0.0))
