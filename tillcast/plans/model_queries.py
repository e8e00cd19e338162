"""Segmentation, forecasting jobs and the classification model."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillcast.functions import dates
from tillcast.operators import (
    aggregates, cell_mean, classify, collecting, decomposable, evaluation, forests, intervals, joins,
    mixed_terms, partial_pooling, quantile_fit, reshape, rows, saturating, seasonal_ar, seasonal_arma,
    segments, selection, series, sparse_trend, stats, trend_uncertainty, windows,
)
from tillcast.operators.decomposable import Config, Design
from tillcast.operators.evaluation import forecast_metrics
from tillcast.plans import forecast_run
from tillcast.plans.catalog import query, rounded
from tillcast.plans.retail_queries import totals
from tillcast.plans.series_queries import EVENTS, KEYS, NUMBERED_SQL, SERIES_SQL, category_series
from tillcast.plans.table_queries import event_list
from tillcast.sources import sinks
from tillcast.sources.files import year_range
from tillcast.sources.shared import materialise, new_path
from tillcast.sources.star import CATEGORIES, PERIODS, calendar_event

# --- segmentation ----------------------------------------------------------------------------

PROFILE = ["total_sales", "average_price", "price_std"]


def _profile(star, key: str):
    return materialise(aggregates.price_profile(star, key), "profile")


@query(
    "cl_scale",
    """WITH {fact}, t AS (SELECT store, sum(sales)::DOUBLE AS total_sales, CAST(sum(sell_price) AS DOUBLE) / count(sell_price) AS average_price
        FROM fact GROUP BY 1)
       SELECT store, round((total_sales - (SELECT avg(total_sales) FROM t)) / (SELECT stddev_pop(total_sales) FROM t), 6) + 0.0 AS total_sales,
         round((average_price - (SELECT avg(average_price) FROM t)) / (SELECT stddev_pop(average_price) FROM t), 6) + 0.0 AS average_price FROM t""",
)
def cl_scale(star):
    profile = star.summarise(["store"], total_sales=("sum", "sales"), average_price=("avg", "sell_price"))
    features = ["total_sales", "average_price"]
    return rounded(segments.scale(profile, features), *features)


@query("cl_elbow")
def cl_elbow(star):
    return segments.elbow(materialise(totals(star, ["store"]), "store-totals"), ["total_sales"])


@query("cl_store_sales")
def cl_store_sales(star):
    return segments.segment(materialise(totals(star, ["store"]), "store-totals"), ["total_sales"], 2)


@query("cl_store_category")
def cl_store_category(star):
    by_both = totals(star, ["store", "category"])
    matrix = reshape.pivot_sum(by_both, ["store"], "category", "total_sales", CATEGORIES)
    return segments.segment(materialise(matrix, "store-category"), [*CATEGORIES, reshape.OTHER], 3)


@query("cl_region_period")
def cl_region_period(star):
    monthly = totals(star, ["region", "date"]).withColumn("period", F.date_format("date", "yyyy_MM"))
    matrix = reshape.pivot_sum(monthly, ["region"], "period", "total_sales", PERIODS)
    return segments.segment(materialise(matrix, "region-period"), [*PERIODS, reshape.OTHER], 3)


@query("cl_product_price")
def cl_product_price(star):
    return segments.segment(_profile(star, "item"), PROFILE, 3)


@query("cl_store_price")
def cl_store_price(star):
    return segments.segment(_profile(star, "store"), PROFILE, 5)


@query("cl_silhouette")
def cl_silhouette(star):
    labelled = segments.segment(_profile(star, "store"), PROFILE, 5)
    return segments.silhouette(labelled, PROFILE)


# --- cell means: the forecasting model that SQL can repeat -----------------------------------

CELL_SQL = (
    SERIES_SQL
    + """, fl AS (SELECT *, isodow(ds) - 1 AS dow, CAST(month(ds) = 12 AND day(ds) IN (23, 24, 26) AS INTEGER) AS chr,
      CAST(month(ds) = 12 AND day(ds) = 25 AS INTEGER) AS hol, max(ds) OVER (PARTITION BY region, category) - ds AS back FROM s),
  tr AS (SELECT * FROM fl WHERE back >= {hold}),
  c1 AS (SELECT region, category, dow, chr, hol, avg(y) AS m FROM tr GROUP BY 1, 2, 3, 4, 5),
  c2 AS (SELECT region, category, dow, avg(y) AS m FROM tr GROUP BY 1, 2, 3),
  c3 AS (SELECT region, category, avg(y) AS m FROM tr GROUP BY 1, 2),
  fc AS (SELECT fl.region, fl.category, fl.ds, fl.y, fl.back, greatest(0, coalesce(c1.m, c2.m, c3.m)) AS yhat FROM fl
    LEFT JOIN c1 ON fl.region = c1.region AND fl.category = c1.category AND fl.dow = c1.dow AND fl.chr = c1.chr AND fl.hol = c1.hol
    LEFT JOIN c2 ON fl.region = c2.region AND fl.category = c2.category AND fl.dow = c2.dow
    LEFT JOIN c3 ON fl.region = c3.region AND fl.category = c3.category)"""
)
CELL_28 = CELL_SQL.replace("{hold}", "28")
CELL_84 = CELL_SQL.replace("{hold}", "84")
DS = "CAST(ds AS VARCHAR) AS ds"


def cell_forecast(star, hold: int = 28, keys=KEYS):
    """All days with the cell means of the days before the last ``hold`` ones as forecast."""
    frame = category_series(star, flags=True, keys=keys)
    whole = Window.partitionBy(*keys)
    frame = frame.withColumn("back", F.datediff(F.max("ds").over(whole), F.col("ds")))
    models = cell_mean.fit(frame.where(F.col("back") >= hold), keys)
    return cell_mean.score(frame, models, keys).select(*keys, "ds", "y", "back", "yhat")


def cell_forecast_tail(star, hold: int = 28, keys=KEYS):
    """The last ``hold`` days of :func:`cell_forecast`, for many thin series.

    Only these days are made; those before count in the cells without rows of their own.
    """
    sold = series.daily_totals(totals(star, [*keys, "date"]), keys, value="total_sales", grouped=True)
    sold = sold.withColumn("_until", F.date_sub(series.last_day(keys), hold))
    train = dates.with_calendar_flags(sold.where(F.col("ds") <= F.col("_until")))
    models = cell_mean.fit(train, keys, until="_until")
    frame = category_series(star, flags=True, keys=keys, tail=hold)
    return cell_mean.score(frame, models, keys).select(*keys, "ds", "y", "yhat")


@query("fc_cell_mean", CELL_28 + f" SELECT region, category, {DS}, y, round(yhat, 6) AS yhat FROM fc WHERE back < 28")
def fc_cell_mean(star):
    return rounded(cell_forecast(star).where(F.col("back") < 28).drop("back"), "yhat")


@query(
    "fc_forecast_frame",
    CELL_28
    + " SELECT CAST(ds AS VARCHAR) AS date, round(yhat, 6) AS forecast_sales, y AS actual_sales, region, category FROM fc WHERE back < 28",
)
def fc_forecast_frame(star):
    scored = cell_forecast(star).where(F.col("back") < 28)
    frame = selection.forecast_frame(scored.select(*KEYS, "ds", "yhat"), category_series(star), KEYS)
    return rounded(frame, "forecast_sales")


@query(
    "agg_forecast_rollup",
    CELL_28
    + """ SELECT CAST(ds AS VARCHAR) AS date, region, round(sum(yhat), 6) AS forecast_sales FROM fc WHERE back < 28 GROUP BY fc.ds, region""",
)
def agg_forecast_rollup(star):
    scored = cell_forecast(star).where(F.col("back") < 28)
    frame = scored.select(F.col("ds").alias("date"), F.col("yhat").alias("forecast_sales"), *KEYS)
    # `city` is not in the frame, so it is left out of the roll-up.
    return rounded(aggregates.rollup_forecast(frame, ["region", "city"]), "forecast_sales")


STORE_CELL_SQL = CELL_28.replace("region, category", "store, department").replace(
    "fl.region = c1.region AND fl.category = c1.category", "fl.store = c1.store AND fl.department = c1.department"
).replace("fl.region = c2.region AND fl.category = c2.category", "fl.store = c2.store AND fl.department = c2.department").replace(
    "fl.region = c3.region AND fl.category = c3.category", "fl.store = c3.store AND fl.department = c3.department"
).replace("fl.region, fl.category", "fl.store, fl.department")


@query(
    "agg_forecast_rollup_department",
    STORE_CELL_SQL
    + """ SELECT CAST(ds AS VARCHAR) AS date, department, round(sum(yhat), 6) AS forecast_sales FROM fc WHERE back < 28 GROUP BY fc.ds, department""",
)
def agg_forecast_rollup_department(star):
    """Forecasts of every store and department, as many series as both have, summed by department."""
    keys = ["store", "department"]
    scored = cell_forecast_tail(star, keys=keys)
    frame = scored.select(F.col("ds").alias("date"), F.col("yhat").alias("forecast_sales"), *keys)
    return rounded(aggregates.rollup_forecast(frame, ["department", "city"]), "forecast_sales")


CANDIDATE_SQL = (
    CELL_28
    + """, w AS (SELECT region, category, ds, back, y, lag(y, 28) OVER (PARTITION BY region, category ORDER BY ds) AS yhat FROM fl),
  cand AS (SELECT region, category, 'cell_mean' AS model_type, ds, y, yhat FROM fc WHERE back < 28
    UNION ALL SELECT region, category, 'four_weeks_before', ds, y, yhat FROM w WHERE back < 28)"""
)


def _candidates(star):
    scored = cell_forecast(star)
    lagged = windows.lags(scored, KEYS, "ds", "y", [28])
    entries = F.array(
        F.struct(F.lit("cell_mean").alias("model_type"), F.col("yhat").alias("yhat")),
        F.struct(F.lit("four_weeks_before").alias("model_type"), F.col("lag_28").alias("yhat")),
    )
    return lagged.where(F.col("back") < 28).select(*KEYS, "ds", "y", F.inline(entries))


@query(
    "fc_select_best",
    CANDIDATE_SQL
    + """, m AS (SELECT region, category, model_type, avg(abs(y - yhat)) AS mae FROM cand WHERE yhat IS NOT NULL GROUP BY 1, 2, 3),
    r AS (SELECT *, row_number() OVER (PARTITION BY region, category ORDER BY mae, model_type) AS rn FROM m)
    SELECT region, category, model_type, round(mae, 6) AS mae FROM r WHERE rn = 1""",
)
def fc_select_best(star):
    known = _candidates(star).where(F.col("yhat").isNotNull())
    metrics = forecast_metrics(known, [*KEYS, "model_type"])
    return rounded(selection.select_best(metrics, KEYS, "mae"), "mae")


@query(
    "fc_fallback",
    CANDIDATE_SQL
    + """ SELECT a.region, a.category, CAST(a.ds AS VARCHAR) AS ds, round(coalesce(a.yhat, b.yhat), 6) AS yhat,
      CASE WHEN a.yhat IS NULL THEN b.model_type ELSE a.model_type END AS model_type
    FROM (SELECT * FROM cand WHERE model_type = 'cell_mean') b JOIN (SELECT * FROM cand WHERE model_type <> 'cell_mean') a
      ON a.region = b.region AND a.category = b.category AND a.ds = b.ds""",
)
def fc_fallback(star):
    """The lagged value stands for a preferred model that failed on some days."""
    named = F.when(F.col("model_type") == "four_weeks_before", "decomposable").otherwise(F.col("model_type"))
    chosen = selection.first_available(_candidates(star).withColumn("model_type", named), KEYS)
    shown = F.when(F.col("model_type") == "decomposable", "four_weeks_before").otherwise(F.col("model_type"))
    return rounded(chosen.withColumn("model_type", shown), "yhat")


@query(
    "fc_clamp_cap",
    """WITH {fact}, t AS (SELECT store, category, sum(sales)::DOUBLE AS y FROM fact GROUP BY 1, 2)
       SELECT store, category, greatest(0.0::DOUBLE, least(y - 200, 300.0::DOUBLE)) AS yhat FROM t""",
)
def fc_clamp_cap(star):
    """The clamp that stands for saturating growth, on its own."""
    raw = totals(star, ["store", "category"])
    value = F.col("total_sales").cast("double") - 200
    return raw.select("store", "category", decomposable.clamp_to_cap(value, F.lit(300.0)).alias("yhat"))


# --- intervals -------------------------------------------------------------------------------


@query(
    "fc_quantiles",
    CELL_28
    + f""", q AS (SELECT region, category, quantile_cont(y - yhat, 0.1) AS a, quantile_cont(y - yhat, 0.9) AS b FROM fc WHERE back >= 28 GROUP BY 1, 2)
    SELECT region, category, {DS}, round(yhat, 6) AS yhat, round(yhat + a, 6) + 0.0 AS lower, round(yhat + b, 6) + 0.0 AS upper FROM fc JOIN q USING (region, category) WHERE back < 28""",
)
def fc_quantiles(star):
    scored = cell_forecast(star)
    fitted, test = scored.where(F.col("back") >= 28), scored.where(F.col("back") < 28)
    df = intervals.residual_quantiles(fitted, test.drop("y", "back"), KEYS, {"lower": 0.1, "upper": 0.9})
    return rounded(df, "yhat", "lower", "upper")


@query(
    "fc_interval_band",
    CELL_28
    + f""", q AS (SELECT region, category, stddev_samp(y - yhat) AS sd FROM fc WHERE back >= 28 GROUP BY 1, 2)
    SELECT region, category, {DS}, round(yhat, 6) AS yhat, round(yhat - 1.2815515655446008::DOUBLE * sd, 6) + 0.0 AS yhat_lower,
      round(yhat + 1.2815515655446008::DOUBLE * sd, 6) AS yhat_upper FROM fc JOIN q USING (region, category) WHERE back < 28""",
)
def fc_interval_band(star):
    scored = cell_forecast(star)
    fitted, test = scored.where(F.col("back") >= 28), scored.where(F.col("back") < 28)
    df = intervals.normal_band(fitted, test.drop("y", "back"), KEYS)
    return rounded(df, "yhat", "yhat_lower", "yhat_upper")


@query("fc_interval_trend")
def fc_interval_trend(star):
    """Intervals from simulated changes of the trend and residuals."""
    train, test = _split(star)
    models = materialise(decomposable.fit(train, KEYS, Design()), "models")
    score = lambda days: decomposable.score(days, models, KEYS, Design(), clamp=False)
    spread = trend_uncertainty.residual_spread(score(train), KEYS)
    draws = trend_uncertainty.simulated(score(test), models, spread, KEYS, Design())
    return trend_uncertainty.band(draws, KEYS)


@query(
    "fc_conformal_naive",
    CELL_84
    + f""", q AS (SELECT region, category, quantile_cont(abs(y - yhat), 0.9) AS qhat FROM fc WHERE back >= 28 AND back < 84 GROUP BY 1, 2)
    SELECT region, category, {DS}, round(yhat, 6) AS yhat, round(qhat, 6) AS qhat, round(yhat - qhat, 6) + 0.0 AS yhat_lower, round(yhat + qhat, 6) AS yhat_upper
    FROM fc JOIN q USING (region, category) WHERE back < 28""",
)
def fc_conformal_naive(star):
    """Fit before the last 84 days, calibrate on 56 of them, predict the last 28."""
    scored = cell_forecast(star, hold=84)
    calibration = scored.where((F.col("back") >= 28) & (F.col("back") < 84))
    test = scored.where(F.col("back") < 28).drop("y", "back")
    df = intervals.conformal_naive(calibration, test, KEYS, alpha=0.1)
    return rounded(df, "yhat", "qhat", "yhat_lower", "yhat_upper")


@query(
    "fc_conformal_cqr",
    CELL_84
    + f""", o AS (SELECT region, category, quantile_cont(y - yhat, 0.1) AS a, quantile_cont(y - yhat, 0.9) AS b FROM fc WHERE back >= 84 GROUP BY 1, 2),
    i AS (SELECT fc.*, yhat + a AS lo, yhat + b AS hi FROM fc JOIN o USING (region, category) WHERE back < 84),
    q AS (SELECT region, category, quantile_cont(greatest(lo - y, y - hi), 0.9) AS qhat FROM i WHERE back >= 28 GROUP BY 1, 2)
    SELECT region, category, {DS}, round(yhat, 6) AS yhat, round(lo, 6) + 0.0 AS lower, round(hi, 6) + 0.0 AS upper, round(qhat, 6) + 0.0 AS qhat,
      round(lo - qhat, 6) + 0.0 AS yhat_lower, round(hi + qhat, 6) + 0.0 AS yhat_upper FROM i JOIN q USING (region, category) WHERE back < 28""",
)
def fc_conformal_cqr(star):
    scored = cell_forecast(star, hold=84)
    fitted, later = scored.where(F.col("back") >= 84), scored.where(F.col("back") < 84)
    banded = intervals.residual_quantiles(fitted, later, KEYS, {"lower": 0.1, "upper": 0.9})
    calibration = banded.where(F.col("back") >= 28)
    test = banded.where(F.col("back") < 28).drop("y", "back")
    df = intervals.conformal_cqr(calibration, test, KEYS, alpha=0.1)
    return rounded(df, "yhat", "lower", "upper", "qhat", "yhat_lower", "yhat_upper")


# --- layouts of multi-step forecasts ---------------------------------------------------------

N_STEPS = 3
LONG_SQL = (
    SERIES_SQL
    + """, lg AS (SELECT a.region, a.category, a.ds AS origin, k AS step, a.ds + k AS ds, b.y AS yhat FROM s a, (SELECT unnest(range(1, 4))::INTEGER AS k)
    JOIN s b ON a.region = b.region AND a.category = b.category AND b.ds = a.ds + k - 7)"""
)


def _multi_step(star):
    """Forecasts made on every day for the next three: the values a week before each target."""
    order = Window.partitionBy(*KEYS).orderBy("ds")
    entries = [
        F.struct(F.lit(k).alias("step"), F.date_add("ds", k).alias("target"), F.lag("y", 7 - k).over(order).alias("yhat"))
        for k in range(1, N_STEPS + 1)
    ]
    made = category_series(star).withColumn("_f", F.array(*entries))
    long = made.select(*KEYS, F.col("ds").alias("origin"), F.inline("_f"))
    return long.where(F.col("yhat").isNotNull()).withColumnRenamed("target", "ds")


@query(
    "fc_collect",
    LONG_SQL
    + f""" SELECT region, category, {DS}, coalesce(max(CASE WHEN step = 1 THEN yhat END), -1) AS yhat1, coalesce(max(CASE WHEN step = 2 THEN yhat END), -1) AS yhat2,
    coalesce(max(CASE WHEN step = 3 THEN yhat END), -1) AS yhat3 FROM lg GROUP BY region, category, lg.ds""",
)
def fc_collect(star):
    return collecting.by_target(_multi_step(star), KEYS, N_STEPS).fillna(-1)


@query(
    "fc_collect_origin",
    LONG_SQL
    + """ SELECT region, category, CAST(lg.origin + 1 AS VARCHAR) AS ds, coalesce(max(CASE WHEN step = 1 THEN yhat END), -1) AS step0,
    coalesce(max(CASE WHEN step = 2 THEN yhat END), -1) AS step1, coalesce(max(CASE WHEN step = 3 THEN yhat END), -1) AS step2
    FROM lg GROUP BY region, category, lg.origin""",
)
def fc_collect_origin(star):
    return collecting.by_origin(_multi_step(star), KEYS, N_STEPS).fillna(-1)


@query(
    "fc_collect_latest",
    LONG_SQL
    + """, r AS (SELECT *, dense_rank() OVER (PARTITION BY region, category ORDER BY origin DESC) - 1 AS age FROM lg),
    u AS (SELECT region, category, ds, -1.0::DOUBLE AS y, yhat, CAST(age AS INTEGER) AS age FROM r WHERE age <= 2)
    SELECT region, category, CAST(ds AS VARCHAR) AS ds, y, yhat, age FROM u
    UNION ALL SELECT region, category, CAST(ds AS VARCHAR), y, -1.0::DOUBLE, -1 FROM s""",
)
def fc_collect_latest(star):
    newest = collecting.latest(_multi_step(star), KEYS, previous=2)
    history = category_series(star)
    both = collecting.with_history(newest, history, KEYS)
    ages = newest.select(*KEYS, "ds", "yhat", "age")
    past = both.where(F.col("y").isNotNull()).withColumn("age", F.lit(-1))
    return past.unionByName(ages, allowMissingColumns=True).fillna(-1, ["y", "yhat"])


HOURLY_SQL = """WITH hrs AS (SELECT unnest(generate_series((SELECT min(date_trunc('hour', ts)) FROM events), (SELECT max(date_trunc('hour', ts)) FROM events), INTERVAL 1 HOUR)) AS ds),
  ids AS (SELECT DISTINCT event_type AS "ID" FROM events), c AS (SELECT event_type AS "ID", date_trunc('hour', ts) AS ds, count(*)::DOUBLE AS y FROM events GROUP BY 1, 2),
  h AS (SELECT ids."ID", hrs.ds, coalesce(y, 0) AS y FROM ids CROSS JOIN hrs LEFT JOIN c ON c."ID" = ids."ID" AND c.ds = hrs.ds),
  req AS (SELECT "ID", max(ds) - INTERVAL 24 HOUR AS start FROM h GROUP BY 1)"""


@query(
    "fc_day_ahead",
    HOURLY_SQL
    + """ SELECT req."ID", strftime(start, '%Y-%m-%d %H:%M:%S') AS start, k AS step, strftime(start + to_hours(k), '%Y-%m-%d %H:%M:%S') AS ds,
    y AS yhat, true AS complete FROM req, (SELECT unnest(range(1, 25))::INTEGER AS k) JOIN h ON h."ID" = req."ID" AND h.ds = start + to_hours(k - 24)""",
)
def fc_day_ahead(star):
    """Hourly event counts; a forecast of step i is the value 24 hours before its target."""
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    counts = star.table("events").groupBy(F.col("event_type").alias("ID"), hour.alias("ds")).agg(
        F.count("*").cast("double").alias("y")
    )
    span = counts.agg(F.struct(F.min("ds").alias("lo"), F.max("ds").alias("hi"))).scalar()
    hours = F.sequence(span["lo"], span["hi"], F.expr("interval 1 hour"))
    ids = counts.select("ID").distinct()
    grid = ids.select("ID", F.explode(hours).alias("ds"))
    hourly = grid.join(counts, ["ID", "ds"], "left").fillna(0.0, ["y"])
    before = F.lag("y", 24).over(Window.partitionBy("ID").orderBy("ds"))
    wide = hourly.select("ID", "ds", *[before.alias(f"yhat{i}") for i in range(1, 25)])
    requests = ids.select("ID", (span["hi"] - F.expr("interval 24 hour")).alias("start"))
    return collecting.day_ahead(wide, requests, ["ID"])


# --- decomposable, autoregressive and pooled models ------------------------------------------


def _split(star, days: int = 28):
    split = series.split_tail_days(category_series(star, flags=True), KEYS, days)
    split = materialise(split, "split")
    return split.where(F.col("split") == "train").drop("split"), split.where(F.col("split") == "test").drop("split")


def _decomposed(star, design: Design, config: Config, scope: str = "local"):
    train, test = _split(star)
    models = decomposable.fit(train, KEYS, design, config, scope)
    return decomposable.score(test, models, KEYS, design).select(*KEYS, "ds", "y", "yhat")


@query("fc_decomposable")
def fc_decomposable(star):
    return _decomposed(star, Design(), Config())


@query("fc_decomposable_monthly_season")
def fc_decomposable_monthly_season(star):
    return _decomposed(star, Design(extra_seasons=((30.5, 5),)), Config())


@query("fc_decomposable_year_ahead")
def fc_decomposable_year_ahead(star):
    """Monthly totals, twelve months ahead."""
    monthly = series.monthly_series(totals(star, [*KEYS, "date"]), KEYS, value="total_sales")
    monthly = materialise(monthly, "monthly")
    design = Design(changepoints=5, yearly_order=3, weekly_order=0, regressors=())
    models = decomposable.fit(monthly.select(*KEYS, "ds", "y"), KEYS, design)
    future = series.future_frame(monthly, KEYS, 12, step="month")
    return decomposable.score(future.select(*KEYS, "ds"), models, KEYS, design).select(*KEYS, "ds", "yhat")


def _saturating(star):
    """Logistic growth up to the largest training value of each series, as the original has it."""
    train, test = _split(star)
    models = materialise(saturating.fit(train, KEYS, Design(), capacity="largest"), "growth")
    return saturating.score(test, models, KEYS, Design())


@query("fc_logistic_cap")
def fc_logistic_cap(star):
    scored = _saturating(star).withColumnRenamed("capacity", "cap")
    inside = F.col("yhat").between(F.lit(0.0), F.col("cap"))
    return scored.select(*KEYS, "ds", "yhat", "growth", "cap", inside.alias("inside"))


@query(
    "fc_logistic_bounds",
    CELL_28
    + f""", c AS (SELECT region, category, max(y) AS cap FROM fc WHERE back >= 28 GROUP BY 1, 2)
    SELECT region, category, {DS}, cap, true AS inside FROM fc JOIN c USING (region, category) WHERE back < 28""",
)
def fc_logistic_bounds(star):
    """The days and capacities of the saturating forecasts, and that none is outside."""
    scored = _saturating(star)
    inside = F.col("yhat").between(F.lit(0.0), F.col("capacity"))
    return scored.select(*KEYS, "ds", F.col("capacity").alias("cap"), inside.alias("inside"))


@query("fc_growth")
def fc_growth(star):
    """Capacity, rate and midpoint of the growth of each running total."""
    running = category_series(star).withColumn(
        "y", F.sum("y").over(Window.partitionBy(*KEYS).orderBy("ds"))
    )
    found = saturating.fit_growth(running, KEYS)
    return found.select(*KEYS, "t0", "span", "capacity", "rate", "midpoint", "converged")


@query("fc_tune")
def fc_tune(star):
    train, _ = _split(star)
    best = decomposable.tune(train, KEYS, Design())
    return rounded(best, "loss")


@query("fc_multiplicative")
def fc_multiplicative(star):
    return _decomposed(star, Design(), Config(mode="multiplicative"))


@query("fc_seasonal_ar")
def fc_seasonal_ar(star):
    """Orders and differences of every series by search."""
    split = series.split_tail_days(category_series(star, flags=True), KEYS, 28)
    return seasonal_arma.forecast(split, KEYS).withColumnRenamed("order", "arima_order")


ONE_LAG_SQL = (
    CELL_28
    + """, l AS (SELECT region, category, ds, back, y, lag(y) OVER (PARTITION BY region, category ORDER BY ds) AS x,
      (ds - min(ds) OVER (PARTITION BY region, category))::DOUBLE AS t FROM fl),
    lt AS (SELECT * FROM l WHERE back >= 28 AND x IS NOT NULL)"""
)


@query(
    "fc_seasonal_ar_one_lag",
    "WITH RECURSIVE" + ONE_LAG_SQL.removeprefix("WITH")
    + """, m AS (SELECT region, category, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, arg_max(y, ds) AS last_y, max(ds) AS last_ds FROM lt GROUP BY 1, 2),
    f(region, category, a, b, ds, yhat, h) AS (SELECT region, category, a, b, last_ds + 1, a + b * last_y, 1 FROM m
      UNION ALL SELECT region, category, a, b, ds + 1, a + b * yhat, h + 1 FROM f WHERE h < 28)
    SELECT region, category, CAST(ds AS VARCHAR) AS ds, round(greatest(yhat, 0), 3) AS yhat FROM f""",
)
def fc_seasonal_ar_one_lag(star):
    """One lag without differences: a recursion that SQL can follow."""
    split = series.split_tail_days(category_series(star, flags=True), KEYS, 28)
    fixed = split.select(*KEYS, F.lit(0).alias("d"), F.lit(0).alias("seasonal_d")).distinct()
    found = seasonal_arma.forecast(split, KEYS, [], ((1, 0, 0, 0),), differences=fixed)
    return rounded(found.select(*KEYS, "ds", "yhat"), "yhat", digits=3)


LAGGED = Design(changepoints=5, yearly_order=3, weekly_order=3, regressors=("is_holiday",), lags=7, lagged_regressors=(("is_christmas", 2),))


@query("fc_decomposable_lags")
def fc_decomposable_lags(star):
    """Seven lags of the series and two of a regressor; each day's forecast feeds the next."""
    train, test = _split(star)
    models = materialise(decomposable.fit_lagged(train, KEYS, LAGGED), "lagged")
    return decomposable.score_recursive(train, test, models, KEYS, LAGGED)


@query(
    "fc_lag_trend",
    "WITH RECURSIVE" + ONE_LAG_SQL.removeprefix("WITH")
    + """, c AS (SELECT region, category, avg(y) AS my, avg(x) AS mx, avg(t) AS mt, var_pop(t) AS tt, var_pop(x) AS xx, covar_pop(t, x) AS tx,
      covar_pop(t, y) AS ty, covar_pop(x, y) AS xy, arg_max(y, ds) AS last_y, max(ds) AS last_ds, max(t) AS last_t FROM lt GROUP BY 1, 2),
    m AS (SELECT *, (ty * xx - xy * tx) / (tt * xx - tx * tx) AS bt, (xy * tt - ty * tx) / (tt * xx - tx * tx) AS bx FROM c),
    f(region, category, a, bt, bx, t, ds, yhat, h) AS (SELECT region, category, my - bt * mt - bx * mx, bt, bx, last_t + 1, last_ds + 1,
        my - bt * mt - bx * mx + bt * (last_t + 1) + bx * last_y, 1 FROM m
      UNION ALL SELECT region, category, a, bt, bx, t + 1, ds + 1, a + bt * (t + 1) + bx * yhat, h + 1 FROM f WHERE h < 28)
    SELECT region, category, CAST(ds AS VARCHAR) AS ds, round(yhat, 3) AS yhat FROM f""",
)
def fc_lag_trend(star):
    """A straight line and one lag."""
    design = Design(changepoints=0, yearly_order=0, weekly_order=0, regressors=(), lags=1)
    train, test = _split(star)
    models = materialise(decomposable.fit_lagged(train, KEYS, design), "lagged")
    return rounded(decomposable.score_recursive(train, test, models, KEYS, design), "yhat", digits=3)


PROBS = {"lower": 0.1, "median": 0.5, "upper": 0.9}


@query("fc_quantile_regression")
def fc_quantile_regression(star):
    train, test = _split(star)
    models = quantile_fit.fit(train, KEYS, Design(), PROBS)
    return quantile_fit.score(test, models, KEYS, Design(), PROBS).select(*KEYS, "ds", "y", *PROBS)


@query(
    "fc_quantile_shares",
    CELL_28
    + """, n AS (SELECT region, category, count(*) AS n FROM fc WHERE back >= 28 GROUP BY 1, 2)
    SELECT region, category, q.name AS quantile, n, true AS holds, 0::BIGINT AS crossed
    FROM n, (VALUES ('lower'), ('median'), ('upper')) q(name)""",
)
def fc_quantile_shares(star):
    """Whether the share of training days below each fitted quantile is within 1 % of its own, and
    the days on which two quantiles cross."""
    train, _ = _split(star)
    scored = quantile_fit.score(train, quantile_fit.fit(train, KEYS, Design(), PROBS), KEYS, Design(), PROBS)
    below = lambda name: F.avg((F.col("y") <= F.col(name) + 1e-9).cast("double"))
    shares = scored.groupBy(*KEYS).agg(
        F.count("*").alias("n"),
        *[(F.abs(below(name) - q) <= 0.01).alias(name) for name, q in PROBS.items()],
        F.count_if((F.col("lower") > F.col("median")) | (F.col("median") > F.col("upper"))).alias("crossed"),
    )
    rows_ = [F.struct(F.lit(n).alias("quantile"), F.col(n).alias("holds")) for n in PROBS]
    return shares.select(*KEYS, "n", "crossed", F.inline(F.array(*rows_)))


# --- terms of the model ----------------------------------------------------------------------


@query("fc_sparse_changepoints")
def fc_sparse_changepoints(star):
    """Few trend changes instead of many small ones."""
    train, test = _split(star)
    models = sparse_trend.fit(train, KEYS, Design()).drop("violation", "changes")
    scored = decomposable.score(test, models, KEYS, Design())
    return scored.select(*KEYS, "ds", "y", "yhat")


@query(
    "fc_sparse_optimality",
    CELL_28
    + " SELECT region, category, count(*) AS n, true AS optimal, true AS fewer FROM fc WHERE back >= 28 GROUP BY 1, 2",
)
def fc_sparse_optimality(star):
    """Whether the sparse fits meet the conditions of an optimum, and a ten times smaller prior scale leaves
    no more changes."""
    train, _ = _split(star)
    days = train.groupBy(*KEYS).agg(F.count("*").alias("n"))
    wide = sparse_trend.fit(train, KEYS, Design(), Config(changepoint_prior_scale=0.1))
    narrow = sparse_trend.fit(train, KEYS, Design(), Config(changepoint_prior_scale=0.01))
    narrow = narrow.select(*KEYS, F.col("violation").alias("other"), F.col("changes").alias("left"))
    both = days.join(wide, KEYS).join(narrow, KEYS)
    return both.select(
        *KEYS, "n", (F.greatest("violation", "other") < 1e-6).alias("optimal"), (F.col("left") <= F.col("changes")).alias("fewer")
    )


MULTIPLICATIVE = {"yearly", "weekly", "is_holiday"}


@query("fc_mixed_terms")
def fc_mixed_terms(star):
    """Seasons and one regressor in proportion to the trend, the other regressors added."""
    train, test = _split(star)
    models = mixed_terms.fit(train, KEYS, Design(), MULTIPLICATIVE)
    scored = mixed_terms.score(test, models, KEYS, Design(), MULTIPLICATIVE)
    return scored.select(*KEYS, "ds", "y", "trend", "multiplicative", "additive", "yhat")


@query(
    "fc_mixed_losses",
    CELL_28
    + " SELECT region, category, true AS never_rises FROM fc WHERE back >= 28 GROUP BY 1, 2",
)
def fc_mixed_losses(star):
    """Whether no round of the alternating fits of the mixed model raises its loss."""
    train, _ = _split(star)
    losses = F.col("losses")
    before = F.slice(losses, 1, F.size(losses) - 1)
    after = F.slice(losses, 2, F.size(losses) - 1)
    falls = F.forall(F.zip_with(before, after, lambda a, b: b <= a * (1 + 1e-12)), lambda x: x)
    models = mixed_terms.fit(train, KEYS, Design(), MULTIPLICATIVE)
    return models.select(*KEYS, falls.alias("never_rises"))


@query("fc_partial_pooling")
def fc_partial_pooling(star):
    """Series drawn towards what all have in common."""
    train, test = _split(star)
    models = partial_pooling.fit(train, KEYS, Design())
    return decomposable.score(test, models, KEYS, Design()).select(*KEYS, "ds", "y", "yhat")


CONDITIONAL = Design(
    weekly_order=0,
    regressors=(*dates.FLAG_COLUMNS, *EVENTS),
    conditional_seasons=((7.0, 3, "on_season"), (7.0, 3, "off_season")),
)


@query("fc_events_and_conditions")
def fc_events_and_conditions(star):
    """Event windows as regressors, and a week for each half of the year."""
    whole = joins.event_flags(category_series(star, flags=True), event_list(star), EVENTS)
    conditions = dates.condition_columns(F.col("ds"))
    whole = whole.withColumns({c: conditions[c] for c in ("on_season", "off_season")})
    split = materialise(series.split_tail_days(whole, KEYS, 28), "split")
    train, test = split.where("split = 'train'").drop("split"), split.where("split = 'test'").drop("split")
    models = decomposable.fit(train, KEYS, CONDITIONAL)
    scored = decomposable.score(test, models, KEYS, CONDITIONAL)
    return scored.select(*KEYS, "ds", "y", "yhat", "conditional", "regressors")


# --- cross-validation of fitted models -------------------------------------------------------


def _fold_summary(star, design: Design):
    scored = decomposable.cross_validate(category_series(star, flags=True), KEYS, design)
    per_fold = evaluation.basic_metrics(scored, [*KEYS, "fold"])
    return evaluation.fold_summary(per_fold, KEYS, "rmse")


@query("ev_cv_model")
def ev_cv_model(star):
    """Errors of the whole model over five growing training parts."""
    return rounded(_fold_summary(star, Design()), "mean", "std", "min", "max")


@query(
    "ev_cv_trend",
    NUMBERED_SQL
    + """, b AS (SELECT r.*, k AS fold, n - (n // 6) * (5 - k) AS upto, n // 6 AS size FROM r, (SELECT unnest(range(1, 6))::INTEGER AS k)),
    tr AS (SELECT region, category, fold, regr_slope(y, rn) AS b, regr_intercept(y, rn) AS a FROM b WHERE rn <= upto - size GROUP BY 1, 2, 3),
    te AS (SELECT b.region, b.category, b.fold, sqrt(avg((y - a - tr.b * rn) * (y - a - tr.b * rn))) AS rmse FROM b
      JOIN tr ON b.region = tr.region AND b.category = tr.category AND b.fold = tr.fold WHERE rn > upto - size AND rn <= upto GROUP BY 1, 2, 3)
    SELECT region, category, round(avg(rmse), 3) AS mean, round(stddev_samp(rmse), 3) AS std, round(min(rmse), 3) AS min, round(max(rmse), 3) AS max
    FROM te GROUP BY 1, 2""",
)
def ev_cv_trend(star):
    """The same with a straight line as model."""
    line = Design(changepoints=0, yearly_order=0, weekly_order=0, regressors=())
    return rounded(_fold_summary(star, line), "mean", "std", "min", "max", digits=3)


@query("fc_seasonal_ar_monthly")
def fc_seasonal_ar_monthly(star):
    monthly = series.monthly_series(totals(star, [*KEYS, "date"]), KEYS, value="total_sales")
    monthly = materialise(monthly.select(*KEYS, "ds", "y"), "monthly")
    known = monthly.withColumn("split", F.lit("train"))
    future = series.future_frame(monthly, KEYS, 12, step="month").select(*KEYS, "ds")
    frame = known.unionByName(future.withColumn("split", F.lit("future")), allowMissingColumns=True)
    return seasonal_ar.forecast(frame, KEYS, regressors=[], orders=((0, 0), (1, 0), (2, 0), (1, 1)), d=0, seasonal_d=1, m=12)


@query("fc_seasonal_ar_plain")
def fc_seasonal_ar_plain(star):
    """Without a season: differenced once, up to three lags."""
    split = series.split_tail_days(category_series(star, flags=True), KEYS, 28)
    orders = tuple((p, 0) for p in range(4))
    return seasonal_ar.forecast(split, KEYS, regressors=[], orders=orders, d=1, seasonal_d=0)


@query("fc_forest_pooled")
def fc_forest_pooled(star):
    daily = totals(star, ["region", "date"]).select(
        "region", F.col("date").alias("ds"), F.col("total_sales").cast("double").alias("y")
    )
    events = star.summarise(["date", "event"], n=("count", "sales")).where(rows.event_present())
    features = materialise(stats.daily_features(daily, ["region"], events), "features")
    split = series.split_fraction(features, ["region"], 0.8)
    train, test = split.where(F.col("split") == "train"), split.where(F.col("split") == "test")
    names = ["day_of_week", "month", "lag_1", "lag_7", "rolling_mean_7", "rolling_std_7", "is_event"]
    return forests.forest_forecast(train, test, names).select("region", "ds", "y", "yhat")


@query("fc_two_step")
def fc_two_step(star):
    """Series by store: about four of five days are empty, so the limit is set at 0.7 here."""
    keys = ["store"]
    sold = series.daily_totals(totals(star, ["store", "date"]), keys, value="total_sales", grouped=True)
    # Shares and last days are found before the empty days are made, so that only days with sales are sorted.
    sold = sold.withColumns({"_zero": series.empty_share(keys), "_last": series.last_day(keys)})
    sparse = series.densify(sold.where(F.col("_zero") > 0.7).drop("_zero"), keys, "ds", {"y": F.lit(0.0)})
    sparse = sparse.withColumns(
        {"day_of_week": dates.day_of_week(F.col("ds")), "month": F.month("ds"), "event": _event_flag()}
    )
    split = materialise(series.split_tail_days(sparse, keys, 28, last="_last").drop("_last"), "sparse")
    train, test = split.where(F.col("split") == "train"), split.where(F.col("split") == "test")
    scored = forests.two_step_forecast(train, test, keys, ["day_of_week", "month", "event"])
    return scored.select(*keys, "ds", "y", "predicted_sale", "yhat")


def _event_flag():
    return calendar_event(F.col("ds")).isNotNull().cast("int")


@query("fc_global")
def fc_global(star):
    return _decomposed(star, Design(), Config(), scope="global")


@query("fc_global_season_local_trend")
def fc_global_season_local_trend(star):
    train, test = _split(star)
    models = decomposable.fit_global_season(train, KEYS, Design())
    return decomposable.score(test, models, KEYS, Design()).select(*KEYS, "ds", "y", "yhat")


@query("fc_components")
def fc_components(star):
    train, test = _split(star)
    models = decomposable.fit(train, KEYS, Design())
    scored = decomposable.score(test, models, KEYS, Design(), clamp=False)
    return scored.select(*KEYS, "ds", "yhat", *Design().groups())


def _model_table(star):
    """Decomposable models and cell means of all series."""
    train, _ = _split(star)
    fitted = decomposable.fit(train, KEYS, Design())
    means = cell_mean.fit(train, KEYS)
    return selection.decomposable_rows(fitted, KEYS).unionByName(selection.cell_mean_rows(means, KEYS))


@query(
    "snk_model_table",
    SERIES_SQL
    + """ SELECT m.model_type, region, category, CAST(max(ds) - 28 AS VARCHAR) AS last_date, m.n::INTEGER AS n_coefficients
    FROM s, (VALUES ('decomposable', 34), ('cell_mean', 29)) m(model_type, n) GROUP BY ALL""",
)
def snk_model_table(star):
    path = new_path(star.spark, "models")
    sinks.write_models(_model_table(star), path)
    stored = star.spark.read.parquet(path)
    return stored.select("model_type", *KEYS, "last_date", F.size("coefficients").alias("n_coefficients"))


@query("fc_batch_score")
def fc_batch_score(star):
    models = materialise(_model_table(star), "models")
    known = models.select(*KEYS).distinct().withColumn("steps", F.lit(7))
    unknown = known.withColumn("category", F.concat(F.col("category"), F.lit(" (other)")))
    return selection.batch_score(known.unionByName(unknown), models, KEYS, Design())


@query(
    "snk_metrics",
    CANDIDATE_SQL
    + """ SELECT region, category, model_type, round(avg(abs(y - yhat)), 6) AS mae, '28' AS horizon
    FROM cand WHERE yhat IS NOT NULL GROUP BY 1, 2, 3""",
)
def snk_metrics(star):
    metrics = forecast_metrics(_candidates(star).where(F.col("yhat").isNotNull()), [*KEYS, "model_type"])
    params = metrics.select(*KEYS, "model_type", F.create_map(F.lit("horizon"), F.lit("28")).alias("params"))
    path = new_path(star.spark, "metrics")
    sinks.write_metrics(sinks.metrics_rows(metrics, params, KEYS), path)
    read = star.spark.read.parquet(path)
    read = read.select(*KEYS, "model_type", "mae", F.col("params")["horizon"].alias("horizon"))
    return rounded(read, "mae")


def _run(star):
    daily = totals(star, [*KEYS, "date"]).withColumnRenamed("total_sales", "sales")
    return forecast_run.run(daily, KEYS)


@query("run_forecasts")
def run_forecasts(star):
    """Clean, split, tune, fit three models, measure, keep the best per series."""
    return _run(star).forecasts


STORE_SQL = """WITH {fact}, d AS (SELECT store, date AS ds, sum(sales)::DOUBLE AS y FROM fact GROUP BY 1, 2),
  sp AS (SELECT store, unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY))::DATE AS ds FROM d GROUP BY 1),
  s AS (SELECT store, ds, coalesce(y, 0) AS y FROM sp LEFT JOIN d USING (store, ds)),
  z AS (SELECT store, avg(CAST(y = 0 AS DOUBLE)) AS zr, max(ds) AS last_ds FROM s GROUP BY 1)"""


def _store_run(star):
    """The whole job with a series for each store, as many as there are stores."""
    daily = totals(star, ["store", "date"]).withColumnRenamed("total_sales", "sales")
    return forecast_run.run(daily, ["store"])


@query(
    "run_status",
    STORE_SQL + " SELECT store, CASE WHEN zr <= 0.9 THEN 'ok' ELSE 'no model' END AS status FROM z",
)
def run_status(star):
    """Which stores get a forecast."""
    return _store_run(star).status.select("store", "status")


@query("run_metrics")
def run_metrics(star):
    """The chosen model of each store, its errors and its parameters."""
    found = _store_run(star).metrics
    return found.withColumn("params", F.to_json("params"))


@query("run_rollup")
def run_rollup(star):
    """Forecasts of all stores summed by day and region."""
    result = _store_run(star)
    regions = star.summarise(["store", "region"], n=("count", "sales")).select("store", "region")
    frame = result.forecasts.join(regions, "store")
    return rounded(aggregates.rollup_forecast(frame, ["region"]), "forecast_sales")


@query(
    "run_top_items",
    """WITH {fact}, t AS (SELECT store, item, sum(sales) AS total FROM fact GROUP BY 1, 2),
      r AS (SELECT *, row_number() OVER (PARTITION BY store ORDER BY total DESC, item) AS rn FROM t),
      d AS (SELECT f.store, f.item, f.date, sum(f.sales) AS y FROM fact f JOIN r ON r.store = f.store AND r.item = f.item AND rn <= 10 GROUP BY 1, 2, 3),
      z AS (SELECT store, item, (max(date) - min(date) + 1)::BIGINT AS n, count(CASE WHEN y <> 0 THEN 1 END) AS sold FROM d GROUP BY 1, 2)
    SELECT store, item, n, round(1 - sold / n::DOUBLE, 6) AS zero_ratio,
      CASE WHEN 1 - sold / n::DOUBLE > 0.9 THEN 'mostly zero' ELSE 'ok' END AS status FROM z""",
)
def run_top_items(star):
    """The ten best-selling items of every store, and whether their series are worth a model."""
    daily = totals(star, ["store", "item", "date"]).withColumnRenamed("total_sales", "sales")
    top = forecast_run.top_series(daily, "store", "item", 10)
    return rounded(forecast_run.screened(top, ["store", "item"]), "zero_ratio")


# --- classification --------------------------------------------------------------------------


def _labelled(star, where):
    columns = ["sell_price", "category", "department", "region", "event", "yearweek", "date", "store_code", "sales"]
    return star.fact(*columns, where=where)


@query("ml_logistic_train")
def ml_logistic_train(star):
    """Share of training rows whose units sold the model predicts."""
    lines = materialise(_labelled(star, year_range(1995, 2000)), "labelled")
    labels = aggregates.value_counts(lines, "sales", classify.N_LABELS)
    train = rows.rows_of_items(lines, labels, "sales")
    scored = classify.predict(classify.train(train), train)
    hit = (F.col("sales") == F.col("predicted_sales")).cast("double")
    return scored.agg(F.count("*").alias("n"), F.avg(hit).alias("accuracy"))


@query("ml_logistic_predict")
def ml_logistic_predict(star):
    lines = materialise(_labelled(star, year_range(1995, 1999)), "labelled")
    labels = aggregates.value_counts(lines, "sales", classify.N_LABELS)
    model = classify.train(rows.rows_of_items(lines, labels, "sales"))
    later = _labelled(star, year_range(2000)).drop("sales")
    return classify.predict(model, later)
