"""Series preparation, statistics and evaluation over daily sales by region and category."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillcast.functions import dates
from tillcast.functions.scalars import significant
from tillcast.operators import evaluation, joins, reshape, rows, series, stats, unit_root, windows
from tillcast.plans.catalog import query, rounded
from tillcast.plans.retail_queries import totals
from tillcast.plans.table_queries import EVENT_LIST_SQL, event_list
from tillcast.sources.shared import materialise
from tillcast.sources.star import CALENDAR_EVENTS

EVENTS = sorted(CALENDAR_EVENTS.values())
KEYS = ["region", "category"]

DAILY_SQL = """d AS (SELECT region, category, date AS ds, sum(sales)::DOUBLE AS y FROM fact GROUP BY 1, 2, 3)"""
SERIES_SQL = (
    "WITH {fact}, "
    + DAILY_SQL
    + """, sp AS (SELECT region, category, unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY))::DATE AS ds
    FROM d GROUP BY 1, 2),
  s AS (SELECT region, category, ds, coalesce(y, 0) AS y FROM sp LEFT JOIN d USING (region, category, ds))"""
)
NUMBERED_SQL = (
    SERIES_SQL
    + """, r AS (SELECT *, row_number() OVER (PARTITION BY region, category ORDER BY ds) AS rn,
    count(*) OVER (PARTITION BY region, category) AS n FROM s)"""
)
DS = "CAST(ds AS VARCHAR) AS ds"
FLAGS_SQL = """CAST(month(ds) = 12 AND day(ds) IN (23, 24, 26) AS INTEGER) AS is_christmas,
  CAST(month(ds) = 12 AND day(ds) = 25 AS INTEGER) AS is_holiday,
  CAST(isodow(ds) - 1 AS INTEGER) AS day_of_week, CAST(isodow(ds) >= 6 AS INTEGER) AS is_weekend"""


def category_series(star, flags: bool = False, keys=KEYS, tail: int | None = None):
    daily = totals(star, [*keys, "date"])
    return series.daily_series(daily, keys, value="total_sales", flags=flags, tail=tail, grouped=tail is not None)


# --- building and cleaning -------------------------------------------------------------------


@query(
    "ts_daily_series",
    SERIES_SQL + f" SELECT region, category, y, {FLAGS_SQL}, {DS} FROM s",
)
def ts_daily_series(star):
    return category_series(star, flags=True)


@query(
    "ts_weekly",
    """WITH {fact}, w AS (SELECT region, category, (date_trunc('week', date) + INTERVAL 6 DAY)::DATE AS ds, sum(sales)::DOUBLE AS y
         FROM fact GROUP BY 1, 2, 3),
       sp AS (SELECT region, category, unnest(generate_series(min(ds), max(ds), INTERVAL 7 DAY))::DATE AS ds FROM w GROUP BY 1, 2)
       SELECT region, category, CAST(sp.ds AS VARCHAR) AS ds, coalesce(y, 0) AS y FROM sp LEFT JOIN w USING (region, category, ds)""",
)
def ts_weekly(star):
    daily = totals(star, [*KEYS, "date"])
    return series.weekly_series(daily, KEYS, value="total_sales").select(*KEYS, "ds", "y")


@query(
    "ts_daily_total",
    """WITH {fact}, d AS (SELECT date AS ds, sum(sales)::DOUBLE AS y FROM fact GROUP BY 1),
       sp AS (SELECT unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY))::DATE AS ds FROM d)
       SELECT CAST(sp.ds AS VARCHAR) AS ds, coalesce(y, 0) AS y FROM sp LEFT JOIN d USING (ds)""",
)
def ts_daily_total(star):
    return series.daily_series(totals(star, ["date"]), [], value="total_sales", flags=False)


@query(
    "ts_monthly",
    """WITH {fact}, d AS (SELECT category, date AS ds, sum(sales) AS y FROM fact GROUP BY 1, 2)
       SELECT category, CAST(last_day(ds) AS VARCHAR) AS ds, sum(y)::DOUBLE AS y,
         sum(CAST(month(ds) = 12 AND day(ds) IN (23, 24, 26) AS INTEGER))::BIGINT AS is_christmas,
         sum(CAST(month(ds) = 12 AND day(ds) = 25 AS INTEGER))::BIGINT AS is_holiday,
         sum(CAST(isodow(ds) >= 6 AS INTEGER))::BIGINT AS is_weekend FROM d GROUP BY category, last_day(d.ds)""",
)
def ts_monthly(star):
    return series.monthly_series(totals(star, ["category", "date"]), ["category"], value="total_sales")


@query(
    "flt_zero_ratio",
    SERIES_SQL
    + """, z AS (SELECT region, category, avg(CAST(y = 0 AS DOUBLE)) AS zr FROM s GROUP BY 1, 2)
    SELECT region, category, CAST(ds AS VARCHAR) AS ds, y FROM s JOIN z USING (region, category) WHERE zr <= 0.9""",
)
def flt_zero_ratio(star):
    return series.drop_mostly_zero(category_series(star), KEYS)


@query(
    "flt_min_length",
    SERIES_SQL
    + """, c AS (SELECT s.*, max(ds) OVER (PARTITION BY region, category) - 28 AS cut FROM s)
    SELECT region, category, count(*) AS n, count(CASE WHEN ds <= cut THEN 1 END) AS n_train,
      count(CASE WHEN ds > cut THEN 1 END) AS n_test,
      CASE WHEN count(*) < 29 THEN 'too short'
        WHEN count(CASE WHEN ds <= cut THEN 1 END) < 2 OR count(CASE WHEN ds > cut THEN 1 END) < 1 THEN 'split too short'
        ELSE 'ok' END AS status FROM c GROUP BY 1, 2""",
)
def flt_min_length(star):
    return series.length_status(category_series(star), KEYS, 28)


Z_SQL = (
    SERIES_SQL
    + """, z AS (SELECT *, (y - avg(y) OVER p) / nullif(stddev_samp(y) OVER p, 0) AS z FROM s
    WINDOW p AS (PARTITION BY region, category))"""
)


@query("ts_outlier_z", Z_SQL + f" SELECT region, category, {DS}, y FROM z WHERE z IS NULL OR abs(z) <= 3")
def ts_outlier_z(star):
    return series.drop_z_outliers(category_series(star), KEYS)


IQR_SQL = (
    SERIES_SQL
    + """, q AS (SELECT region, category, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.75) AS q3 FROM s GROUP BY 1, 2),
  b AS (SELECT s.*, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM s JOIN q USING (region, category))"""
)


@query("ts_outlier_iqr", IQR_SQL + f" SELECT region, category, {DS}, y FROM b WHERE y BETWEEN lo AND hi")
def ts_outlier_iqr(star):
    return series.drop_iqr_outliers(category_series(star), KEYS)


@query(
    "ts_outlier_iqr_rows",
    IQR_SQL + f" SELECT region, category, {DS}, y, lo AS iqr_low, hi AS iqr_high FROM b WHERE NOT y BETWEEN lo AND hi",
)
def ts_outlier_iqr_rows(star):
    return series.iqr_outliers(category_series(star), KEYS)


@query(
    "ts_anomalies",
    """WITH {fact}, d AS (SELECT date AS ds, sum(sales)::DOUBLE AS y FROM fact GROUP BY 1),
       z AS (SELECT ds, y, (y - (SELECT avg(y) FROM d)) / (SELECT stddev_samp(y) FROM d) AS z FROM d)
       SELECT CAST(ds AS VARCHAR) AS ds, y, round(z, 6) AS z FROM z WHERE abs(z) > 3""",
)
def ts_anomalies(star):
    daily = totals(star, ["date"]).select(F.col("date").alias("ds"), F.col("total_sales").cast("double").alias("y"))
    return rounded(series.z_outliers(daily, []), "z")


REFILL_SQL = (
    Z_SQL
    + """, k AS (SELECT region, category, ds, y FROM z WHERE z IS NULL OR abs(z) <= 3),
  sp2 AS (SELECT region, category, unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY))::DATE AS ds FROM k GROUP BY 1, 2),
  clean AS (SELECT region, category, ds, coalesce(y, 0) AS y FROM sp2 LEFT JOIN k USING (region, category, ds))"""
)


@query("ts_refill_after_clean", REFILL_SQL + f" SELECT region, category, y, {FLAGS_SQL}, {DS} FROM clean")
def ts_refill_after_clean(star):
    return series.refill(series.drop_z_outliers(category_series(star), KEYS), KEYS)


@query(
    "ts_refill_interpolate",
    REFILL_SQL
    + """, nb AS (SELECT *, lead(ds) OVER w AS nds, lead(y) OVER w AS ny FROM k WINDOW w AS (PARTITION BY region, category ORDER BY ds))
    SELECT sp2.region, sp2.category, CAST(sp2.ds AS VARCHAR) AS ds,
      round(CASE WHEN sp2.ds = nb.ds THEN nb.y ELSE nb.y + (nb.ny - nb.y) * (sp2.ds - nb.ds) / (nb.nds - nb.ds) END, 6) AS y
    FROM sp2 JOIN nb ON sp2.region = nb.region AND sp2.category = nb.category AND sp2.ds >= nb.ds
      AND (sp2.ds < nb.nds OR nb.nds IS NULL)""",
)
def ts_refill_interpolate(star):
    cleaned = series.drop_z_outliers(category_series(star), KEYS)
    return rounded(series.refill(cleaned, KEYS, mode="interpolate").select(*KEYS, "ds", "y"), "y")


@query(
    "ts_impute",
    "WITH {fact}, "
    + DAILY_SQL
    + """, nb AS (SELECT *, lead(ds) OVER w AS nds, lead(y) OVER w AS ny,
      avg(y) OVER (PARTITION BY region, category ORDER BY ds ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS m
      FROM d WINDOW w AS (PARTITION BY region, category ORDER BY ds)),
    sp AS (SELECT region, category, unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY))::DATE AS ds FROM d GROUP BY 1, 2)
    SELECT sp.region, sp.category, CAST(sp.ds AS VARCHAR) AS ds, CAST(sp.ds <> nb.ds AS INTEGER) AS imputed,
      round(CASE WHEN sp.ds = nb.ds THEN nb.y WHEN nb.nds - nb.ds - 1 <= 5 THEN nb.y + (nb.ny - nb.y) * (sp.ds - nb.ds) / (nb.nds - nb.ds)
        ELSE m END, 6) AS y
    FROM sp JOIN nb ON sp.region = nb.region AND sp.category = nb.category AND sp.ds >= nb.ds
      AND (sp.ds < nb.nds OR nb.nds IS NULL)""",
)
def ts_impute(star):
    observed = totals(star, [*KEYS, "date"]).select(
        *KEYS, F.col("date").alias("ds"), F.col("total_sales").cast("double").alias("y")
    )
    return rounded(series.impute_gaps(observed, KEYS), "y")


# --- splits and folds ------------------------------------------------------------------------


@query(
    "ts_split_tail_days",
    SERIES_SQL
    + f""" SELECT region, category, {DS}, y, CASE WHEN s.ds <= max(s.ds) OVER (PARTITION BY region, category) - 28
    THEN 'train' ELSE 'test' END AS split FROM s""",
)
def ts_split_tail_days(star):
    return series.split_tail_days(category_series(star), KEYS, 28)


@query(
    "ts_split_fraction",
    NUMBERED_SQL
    + f" SELECT region, category, {DS}, y, CASE WHEN rn <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM r",
)
def ts_split_fraction(star):
    return series.split_fraction(category_series(star), KEYS, 0.8)


@query(
    "ts_split_fraction_global",
    SERIES_SQL
    + f""", g AS (SELECT min(ds) AS lo, max(ds) AS hi FROM s)
    SELECT region, category, {DS}, y, CASE WHEN ds - lo < floor((hi - lo + 1) * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM s, g""",
)
def ts_split_fraction_global(star):
    return series.split_fraction(category_series(star), KEYS, 0.8, local=False)


@query(
    "ts_split_year",
    SERIES_SQL
    + f" SELECT region, category, {DS}, y, CASE WHEN year(s.ds) < 2000 THEN 'train' ELSE 'test' END AS split FROM s WHERE year(s.ds) <= 2000",
)
def ts_split_year(star):
    return series.split_year(category_series(star), 2000)


@query(
    "ts_split_three_way",
    NUMBERED_SQL
    + f""", f AS (SELECT *, floor(n * (1.0::DOUBLE - 0.1::DOUBLE)) AS fit FROM r)
    SELECT region, category, {DS}, y, CASE WHEN rn <= floor(fit * (1.0::DOUBLE - 0.2::DOUBLE)) THEN 'train' WHEN rn <= fit THEN 'valid' ELSE 'test' END AS split FROM f""",
)
def ts_split_three_way(star):
    return series.split_three_way(category_series(star), KEYS, valid=0.2, test=0.1)


def _fold_digest(folds, *extra):
    """Rows, first and last day and total of every fold part: enough to tell folds apart."""
    return folds.groupBy(*KEYS, *extra, "split").agg(
        F.count("*").alias("n"),
        F.min("ds").alias("first_ds"),
        F.max("ds").alias("last_ds"),
        F.sum("y").alias("total"),
    )


DIGEST_SQL = """count(*) AS n, CAST(min(ds) AS VARCHAR) AS first_ds, CAST(max(ds) AS VARCHAR) AS last_ds, sum(y) AS total"""


@query(
    "ts_cv_expanding",
    NUMBERED_SQL
    + f""", b AS (SELECT r.*, k AS fold, n - (n // 6) * (5 - k) AS upto, n // 6 AS size FROM r, (SELECT unnest(range(1, 6))::INTEGER AS k))
    SELECT region, category, fold, CASE WHEN rn <= upto - size THEN 'train' ELSE 'test' END AS split, {DIGEST_SQL}
    FROM b WHERE rn <= upto GROUP BY 1, 2, 3, 4""",
)
def ts_cv_expanding(star):
    return _fold_digest(series.folds_expanding(category_series(star), KEYS, 5), "fold")


@query(
    "ts_cv_rolling_origin",
    NUMBERED_SQL
    + f""", z AS (SELECT *, floor(n * 0.1::DOUBLE) AS size FROM r),
    b AS (SELECT z.*, k AS fold, n - (size - floor(size * 0.5::DOUBLE)) * (5 - k) AS upto FROM z, (SELECT unnest(range(1, 6))::INTEGER AS k))
    SELECT region, category, fold, CASE WHEN rn <= upto - size THEN 'train' ELSE 'test' END AS split, {DIGEST_SQL}
    FROM b WHERE rn <= upto GROUP BY 1, 2, 3, 4""",
)
def ts_cv_rolling_origin(star):
    folds = series.folds_rolling_origin(category_series(star), KEYS, 5, 0.1, 0.5)
    return _fold_digest(folds, "fold")


@query(
    "ts_cv_horizon",
    SERIES_SQL
    + f""", e AS (SELECT region, category, min(ds) AS lo, max(ds) AS hi FROM s GROUP BY 1, 2),
    c AS (SELECT region, category, unnest(generate_series(hi - 30, lo + 365, -INTERVAL 90 DAY))::DATE AS cutoff FROM e WHERE hi - 30 >= lo + 365)
    SELECT s.region, s.category, CAST(cutoff AS VARCHAR) AS cutoff, CASE WHEN ds <= cutoff THEN 'train' ELSE 'test' END AS split, {DIGEST_SQL}
    FROM s JOIN c ON s.region = c.region AND s.category = c.category AND s.ds <= c.cutoff + 30 GROUP BY s.region, s.category, c.cutoff, 4""",
)
def ts_cv_horizon(star):
    folds = series.folds_horizon(category_series(star), KEYS, initial=365, period=90, horizon=30)
    return _fold_digest(folds, "cutoff")


@query(
    "ts_cv_double",
    NUMBERED_SQL
    + f""", z AS (SELECT *, floor(n * (0.1::DOUBLE / 3)) AS ts FROM r),
    y2 AS (SELECT *, n - ts * 2 - ts AS rest FROM z),
    x AS (SELECT *, floor(rest * (0.1::DOUBLE / 3)) AS vs FROM y2),
    b AS (SELECT x.*, k AS fold, 'test' AS kind, n - ts * (3 - k) AS upto, ts AS size FROM x, (SELECT unnest(range(1, 4))::INTEGER AS k)
      UNION ALL SELECT x.*, k, 'valid', rest - vs * (3 - k), vs FROM x, (SELECT unnest(range(1, 4))::INTEGER AS k))
    SELECT region, category, kind, fold, CASE WHEN rn <= upto - size THEN 'train' ELSE 'test' END AS split, {DIGEST_SQL}
    FROM b WHERE rn <= upto GROUP BY 1, 2, 3, 4, 5""",
)
def ts_cv_double(star):
    folds = series.folds_double(category_series(star), KEYS, k=3, valid_pct=0.1, test_pct=0.1)
    return _fold_digest(folds, "kind", "fold")


# --- frames and features ---------------------------------------------------------------------


def _future_sql(select: str) -> str:
    return (
        SERIES_SQL
        + f""", l AS (SELECT region, category, max(ds) AS m FROM s GROUP BY 1, 2), i AS (SELECT unnest(range(1, 29))::INTEGER AS i),
        f AS (SELECT region, category, {select} AS ds FROM l, i)"""
    )


@query(
    "ts_future_frame",
    _future_sql("m + i") + f" SELECT region, category, {FLAGS_SQL}, {DS} FROM (SELECT region, category, ds FROM f UNION ALL SELECT region, category, ds FROM s)",
)
def ts_future_frame(star):
    return series.future_frame(category_series(star), KEYS, 28, history=True)


@query(
    "ts_future_frame_month",
    _future_sql("last_day((m + to_months(i))::DATE)") + f" SELECT region, category, {FLAGS_SQL}, {DS} FROM f",
)
def ts_future_frame_month(star):
    return series.future_frame(category_series(star), KEYS, 28, step="month")


@query("ts_future_frame_week", _future_sql("m + 7 * i") + f" SELECT region, category, {FLAGS_SQL}, {DS} FROM f")
def ts_future_frame_week(star):
    return series.future_frame(category_series(star), KEYS, 28, step="week")


@query(
    "ts_event_frame",
    SERIES_SQL
    + ", "
    + EVENT_LIST_SQL
    + ", fl AS (SELECT ds, "
    + ", ".join(f"max(CASE WHEN event = '{e}' THEN 1 ELSE 0 END) AS \"{e}\"" for e in EVENTS)
    + " FROM x GROUP BY 1) SELECT region, category, CAST(s.ds AS VARCHAR) AS ds, y, "
    + ", ".join(f'coalesce("{e}", 0) AS "{e}"' for e in EVENTS)
    + " FROM s LEFT JOIN fl ON s.ds = fl.ds",
)
def ts_event_frame(star):
    return joins.event_flags(category_series(star), event_list(star), EVENTS)


@query(
    "ts_country_holidays",
    SERIES_SQL
    + """, h AS (SELECT DISTINCT date AS ds FROM fact WHERE event IN ('Christmas', 'NewYear', 'Independence'))
    SELECT region, category, CAST(s.ds AS VARCHAR) AS ds, y, CAST(h.ds IS NOT NULL AS INTEGER) AS holiday FROM s LEFT JOIN h ON s.ds = h.ds""",
)
def ts_country_holidays(star):
    """The holiday table of a country is the caller's; here it is taken from the fact's events."""
    named = star.summarise(["date", "event"], n=("count", "sales"))
    holidays = named.where(F.col("event").isin("Christmas", "NewYear", "Independence")).select(
        F.lit("holiday").alias("event"), F.col("date").alias("ds"),
        F.lit(0).alias("lower_window"), F.lit(0).alias("upper_window"),
    )
    return joins.event_flags(category_series(star), holidays, ["holiday"])


STEP_SQL = """g AS (SELECT region, category, ds - lag(ds) OVER (PARTITION BY region, category ORDER BY ds) AS step FROM d),
  c AS (SELECT region, category, step, count(*) AS c FROM g WHERE step IS NOT NULL GROUP BY 1, 2, 3),
  st AS (SELECT region, category, CAST(arg_min(step, step - c * 1000000) AS INTEGER) AS step_days FROM c GROUP BY 1, 2)"""


def _observed(star):
    return totals(star, [*KEYS, "date"]).select(*KEYS, F.col("date").alias("ds"))


@query(
    "ts_infer_freq",
    "WITH {fact}, " + DAILY_SQL + ", " + STEP_SQL + " SELECT region, category, step_days, step_days = 1 AS is_daily FROM st",
)
def ts_infer_freq(star):
    return series.infer_step(_observed(star), KEYS)


@query(
    "ts_auto_seasonality",
    "WITH {fact}, "
    + DAILY_SQL
    + ", "
    + STEP_SQL
    + """, sp AS (SELECT region, category, CAST(max(ds) - min(ds) + 1 AS INTEGER) AS span_days FROM d GROUP BY 1, 2)
    SELECT region, category, span_days, step_days, step_days < 365 AND span_days >= 730 AS yearly,
      step_days < 7 AND span_days >= 14 AS weekly, step_days < 1 AND span_days >= 2 AS daily FROM sp JOIN st USING (region, category)""",
)
def ts_auto_seasonality(star):
    return series.auto_seasonality(_observed(star), KEYS)


@query(
    "ts_lag_matrix",
    SERIES_SQL
    + """, l AS (SELECT region, category, ds, y, CAST(isodow(ds) - 1 AS INTEGER) AS day_of_week,
      lag(y, 1) OVER w AS y_lag_1, lag(y, 2) OVER w AS y_lag_2, lag(y, 3) OVER w AS y_lag_3,
      lag(CAST(isodow(ds) - 1 AS INTEGER), 1) OVER w AS day_of_week_lag_1, lag(CAST(isodow(ds) - 1 AS INTEGER), 2) OVER w AS day_of_week_lag_2
      FROM s WINDOW w AS (PARTITION BY region, category ORDER BY ds))
    SELECT * REPLACE (CAST(ds AS VARCHAR) AS ds) FROM l WHERE y_lag_3 IS NOT NULL""",
)
def ts_lag_matrix(star):
    frame = category_series(star).withColumn("day_of_week", dates.day_of_week(F.col("ds")))
    return series.lag_matrix(frame, KEYS, 3, {"day_of_week": 2})


@query(
    "ts_normalise",
    SERIES_SQL
    + f""" SELECT region, category, {DS}, y, round((y - min(y) OVER p) / nullif(max(y) OVER p - min(y) OVER p, 0), 6) AS y_norm
    FROM s WINDOW p AS (PARTITION BY region, category)""",
)
def ts_normalise(star):
    return rounded(series.normalise(category_series(star), KEYS), "y_norm")


@query(
    "ts_normalise_global",
    SERIES_SQL
    + f""" SELECT region, category, {DS}, y, round((y - avg(y) OVER ()) / stddev_samp(y) OVER (), 6) AS y_norm FROM s""",
)
def ts_normalise_global(star):
    return rounded(series.normalise(category_series(star), KEYS, "zscore", local=False), "y_norm")


def _fourier_sql(period: float, order: int, prefix: str) -> str:
    day = "(ds - DATE '1970-01-01')"
    parts = []
    for k in range(1, order + 1):
        angle = f"{day} * ({2.0 * 3.141592653589793 * k / period!r}::DOUBLE)"
        parts += [f"round(sin({angle}), 6) + 0.0 AS {prefix}_sin_{k}", f"round(cos({angle}), 6) + 0.0 AS {prefix}_cos_{k}"]
    return ", ".join(parts)


def fourier_columns(prefix: str, period: float, order: int, condition=None):
    terms = series.fourier(F.col("ds"), period, order, condition)
    names = [f"{prefix}_{f}_{k}" for k in range(1, order + 1) for f in ("sin", "cos")]
    return dict(zip(names, terms))


@query(
    "ts_fourier",
    SERIES_SQL
    + f""" SELECT region, category, {_fourier_sql(365.25, 6, "yearly")}, {_fourier_sql(7, 4, "weekly")},
    CASE WHEN month(s.ds) IN (6, 7, 8) THEN round(sin((s.ds - DATE '1970-01-01') * ({2.0 * 3.141592653589793 / 30.5!r}::DOUBLE)), 6) ELSE 0 END + 0.0 AS summer_sin_1,
    CASE WHEN month(s.ds) IN (6, 7, 8) THEN round(cos((s.ds - DATE '1970-01-01') * ({2.0 * 3.141592653589793 / 30.5!r}::DOUBLE)), 6) ELSE 0 END + 0.0 AS summer_cos_1,
    CAST(s.ds AS VARCHAR) AS ds FROM s""",
)
def ts_fourier(star):
    summer = dates.condition_columns(F.col("ds"))["summer"]
    columns = fourier_columns("yearly", 365.25, 6) | fourier_columns("weekly", 7, 4)
    columns |= fourier_columns("summer", 30.5, 1, summer)
    df = category_series(star).drop("y").withColumns(columns)
    return rounded(df, *columns)


@query(
    "ts_trend_basis",
    SERIES_SQL
    + """, t AS (SELECT region, category, ds, coalesce((ds - min(ds) OVER p)::DOUBLE / nullif(max(ds) OVER p - min(ds) OVER p, 0), 0) AS t
      FROM s WINDOW p AS (PARTITION BY region, category))
    SELECT region, category, CAST(ds AS VARCHAR) AS ds, round(t, 6) AS t, """
    + ", ".join(f"round(greatest(0, t - {0.8 * j / 11!r}::DOUBLE), 6) AS hinge_{j}" for j in range(1, 11))
    + " FROM t",
)
def ts_trend_basis(star):
    df = category_series(star).drop("y").withColumn("t", series.scaled_time(KEYS))
    hinges = {f"hinge_{j}": h for j, h in enumerate(series.trend_basis(F.col("t")), start=1)}
    return rounded(df.withColumns(hinges), "t", *hinges)


# --- statistics ------------------------------------------------------------------------------

ELASTICITY_SQL = """WITH {fact}, a AS (SELECT item, date, sum(sales)::DOUBLE AS sales, CAST(sum(sell_price) AS DOUBLE) / count(sell_price) AS price FROM fact GROUP BY 1, 2),
  p AS (SELECT item, date, sales / nullif(lag(sales) OVER w, 0) - 1 AS ds, price / nullif(lag(price) OVER w, 0) - 1 AS dp FROM a
    WINDOW w AS (PARTITION BY item ORDER BY date)),
  e AS (SELECT item, date, ds / nullif(dp, 0) AS elasticity FROM p WHERE ds IS NOT NULL AND dp IS NOT NULL)"""


def _price_sales(star):
    return star.summarise(["date", "item"], sales=("sum", "sales"), sell_price=("avg", "sell_price"))


@query(
    "st_elasticity",
    ELASTICITY_SQL + " SELECT item, round(avg(elasticity), 6) + 0.0 AS elasticity FROM e GROUP BY item",
)
def st_elasticity(star):
    return rounded(stats.mean_elasticity(_price_sales(star)), "elasticity")


@query(
    "st_elasticity_daily",
    ELASTICITY_SQL + " SELECT item, CAST(date AS VARCHAR) AS date, round(elasticity, 6) + 0.0 AS elasticity FROM e",
)
def st_elasticity_daily(star):
    return rounded(stats.price_elasticity(_price_sales(star)).select("item", "date", "elasticity"), "elasticity")


@query(
    "st_corr_matrix",
    """WITH {fact}, c AS (SELECT DISTINCT category FROM fact), dd AS (SELECT DISTINCT date FROM fact),
       t AS (SELECT date, category, sum(sales)::DOUBLE AS y FROM fact GROUP BY 1, 2),
       f AS (SELECT dd.date, c.category, coalesce(y, 0) AS y FROM dd CROSS JOIN c LEFT JOIN t ON t.date = dd.date AND t.category = c.category)
       SELECT x.category AS a, z.category AS b, round(corr(x.y, z.y), 6) + 0.0 AS corr FROM f x JOIN f z ON x.date = z.date AND x.category <= z.category GROUP BY 1, 2""",
)
def st_corr_matrix(star):
    daily = totals(star, ["date", "category"])
    return rounded(stats.correlation_matrix(daily, "category", "date", "total_sales"), "corr")


@query(
    "st_decompose",
    """WITH {fact}, d AS (SELECT region, date AS ds, sum(sales)::DOUBLE AS y FROM fact GROUP BY 1, 2),
       sp AS (SELECT region, unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY))::DATE AS ds FROM d GROUP BY 1),
       s AS (SELECT region, ds, coalesce(y, 0) AS y FROM sp LEFT JOIN d USING (region, ds)),
       t AS (SELECT *, CASE WHEN count(y) OVER w = 7 THEN avg(y) OVER w END AS trend FROM s
         WINDOW w AS (PARTITION BY region ORDER BY ds ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
       ph AS (SELECT region, isodow(ds) AS k, avg(y - trend) AS m FROM t GROUP BY 1, 2),
       se AS (SELECT region, k, m - avg(m) OVER (PARTITION BY region) AS seasonal FROM ph)
       SELECT t.region, CAST(ds AS VARCHAR) AS ds, y, round(trend, 6) AS trend, round(seasonal, 6) + 0.0 AS seasonal,
         round(y - trend - seasonal, 6) + 0.0 AS resid FROM t JOIN se ON t.region = se.region AND isodow(t.ds) = se.k""",
)
def st_decompose(star):
    daily = series.daily_series(totals(star, ["region", "date"]), ["region"], value="total_sales", flags=False)
    return rounded(stats.decompose(daily, ["region"]), "trend", "seasonal", "resid")


@query(
    "st_features",
    """WITH {fact}, d AS (SELECT region, date AS ds, sum(sales)::DOUBLE AS y FROM fact GROUP BY 1, 2),
       e AS (SELECT DISTINCT date FROM fact WHERE event IS NOT NULL),
       f AS (SELECT region, ds, y, CAST(isodow(ds) - 1 AS INTEGER) AS day_of_week, CAST(month(ds) AS INTEGER) AS month,
         lag(y, 1) OVER w AS lag_1, lag(y, 7) OVER w AS lag_7,
         round(avg(y) OVER w7, 6) AS rolling_mean_7, round(stddev_samp(y) OVER w7, 6) AS rolling_std_7,
         CAST(ds IN (SELECT date FROM e) AS INTEGER) AS is_event FROM d
         WINDOW w AS (PARTITION BY region ORDER BY ds), w7 AS (PARTITION BY region ORDER BY ds ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
       SELECT * REPLACE (CAST(ds AS VARCHAR) AS ds) FROM f WHERE lag_7 IS NOT NULL""",
)
def st_features(star):
    daily = totals(star, ["region", "date"]).select(
        "region", F.col("date").alias("ds"), F.col("total_sales").cast("double").alias("y")
    )
    events = star.summarise(["date", "event"], n=("count", "sales")).where(rows.event_present())
    return rounded(stats.daily_features(daily, ["region"], events), "rolling_mean_7", "rolling_std_7")


@query(
    "st_stationarity",
    SERIES_SQL
    + """, c AS (SELECT region, category, lag(y) OVER w AS x, y - lag(y) OVER w AS dy FROM s WINDOW w AS (PARTITION BY region, category ORDER BY ds)),
    r AS (SELECT region, category, count(*) AS n, regr_sxx(dy, x) AS sxx, regr_syy(dy, x) AS syy, regr_sxy(dy, x) AS sxy
      FROM c WHERE x IS NOT NULL GROUP BY 1, 2),
    t AS (SELECT region, category, n, (sxy / nullif(sxx, 0)) / nullif(sqrt(greatest((syy - sxy / nullif(sxx, 0) * sxy) / nullif(n - 2, 0), 0) / nullif(sxx, 0)), 0) AS t FROM r)
    SELECT region, category, n, round(t, 6) AS df_statistic, CASE WHEN t < -2.86 THEN 0 ELSE 1 END AS suggested_d FROM t""",
)
def st_stationarity(star):
    return rounded(stats.stationarity(category_series(star), KEYS), "df_statistic")


@query("st_stationarity_augmented")
def st_stationarity_augmented(star):
    """With as many lagged changes as the AIC asks for, and a p-value."""
    return rounded(unit_root.augmented(category_series(star), KEYS), "adf_statistic", "p_value")


@query(
    "st_stationarity_one_lag",
    SERIES_SQL
    + """, a AS (SELECT region, category, ds, lag(y) OVER w AS x, y - lag(y) OVER w AS dy FROM s WINDOW w AS (PARTITION BY region, category ORDER BY ds)),
    c AS (SELECT *, lag(dy) OVER (PARTITION BY region, category ORDER BY ds) AS z FROM a),
    r AS (SELECT region, category, count(*) AS n, regr_sxx(dy, x) AS xx, regr_sxx(dy, z) AS zz, regr_syy(dy, x) AS yy, regr_sxy(dy, x) AS xy,
      regr_sxy(dy, z) AS zy, regr_sxy(x, z) AS xz FROM c WHERE z IS NOT NULL GROUP BY 1, 2),
    b AS (SELECT *, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS bx, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS bz FROM r),
    t AS (SELECT region, category, n, bx / sqrt((yy - bx * xy - bz * zy) / (n - 3) * zz / (xx * zz - xz * xz)) AS t FROM b)
    SELECT region, category, n, 1::INTEGER AS lags, round(t, 3) AS adf_statistic FROM t""",
)
def st_stationarity_one_lag(star):
    found = unit_root.augmented(category_series(star), KEYS, fixed=1)
    return rounded(found.select(*KEYS, "n", "lags", "adf_statistic"), "adf_statistic", digits=3)


RESIDUAL_SQL = (
    SERIES_SQL
    + """, f AS (SELECT region, category, ds, y, avg(y) OVER (PARTITION BY region, category, isodow(ds)) AS yhat FROM s),
  e AS (SELECT *, y - yhat AS residual FROM f)"""
)


def weekday_mean_fit(star):
    """Series with the mean of its weekday as fitted value."""
    fit = category_series(star)
    same_day = Window.partitionBy(*KEYS, dates.day_of_week(F.col("ds")))
    return fit.withColumn("yhat", F.avg("y").over(same_day))


@query(
    "st_residuals",
    RESIDUAL_SQL + f" SELECT region, category, {DS}, y, round(yhat, 6) AS yhat, round(residual, 6) + 0.0 AS residual FROM e",
)
def st_residuals(star):
    return rounded(stats.residuals(weekday_mean_fit(star)), "yhat", "residual")


@query(
    "st_acf",
    RESIDUAL_SQL
    + """, c AS (SELECT region, category, ds, residual - avg(residual) OVER (PARTITION BY region, category) AS e FROM e),
    n AS (SELECT *, row_number() OVER (PARTITION BY region, category ORDER BY ds) AS rn FROM c),
    v AS (SELECT region, category, sum(e * e) AS v FROM n GROUP BY 1, 2),
    p AS (SELECT a.region, a.category, k AS lag, sum(a.e * b.e) AS sp FROM n a, (SELECT unnest(range(1, 51))::INTEGER AS k)
      JOIN n b ON a.region = b.region AND a.category = b.category AND b.rn = a.rn - k GROUP BY 1, 2, 3)
    SELECT region, category, lag, round(sp / nullif(v, 0), 6) + 0.0 AS acf FROM p JOIN v USING (region, category)""",
)
def st_acf(star):
    fitted = stats.residuals(weekday_mean_fit(star))
    return rounded(stats.autocorrelation(fitted, KEYS, "residual", 50), "acf")


# --- evaluation ------------------------------------------------------------------------------

# Forecasts to evaluate: the value seven and fourteen days earlier, over the last 28 days.
FORECAST_SQL = (
    SERIES_SQL
    + """, l AS (SELECT region, category, ds, y, lag(y, 7) OVER w AS week_before, lag(y, 14) OVER w AS two_weeks_before,
      max(ds) OVER (PARTITION BY region, category) AS m FROM s WINDOW w AS (PARTITION BY region, category ORDER BY ds)),
  f AS (SELECT region, category, 'week_before' AS model_type, ds, y, week_before AS yhat FROM l WHERE ds > m - 28
    UNION ALL SELECT region, category, 'two_weeks_before', ds, y, two_weeks_before FROM l WHERE ds > m - 28)"""
)
MODEL_KEYS = [*KEYS, "model_type"]


def naive_forecasts(star, keys=KEYS):
    lagged = windows.lags(category_series(star, keys=keys), keys, "ds", "y", [7, 14])
    test = series.split_tail_days(lagged, keys, 28).where(F.col("split") == "test")
    entries = F.array(
        F.struct(F.lit("week_before").alias("model_type"), F.col("lag_7").alias("yhat")),
        F.struct(F.lit("two_weeks_before").alias("model_type"), F.col("lag_14").alias("yhat")),
    )
    return test.select(*keys, "ds", "y", F.inline(entries))


METRICS_SQL = (
    FORECAST_SQL
    + """, g AS (SELECT *, abs(y - yhat) AS e, abs(y - lag(y) OVER (PARTITION BY region, category, model_type ORDER BY ds)) AS step FROM f),
  m AS (SELECT region, category, model_type, count(*) AS n, sqrt(avg(e * e)) AS rmse, avg(e * e) AS mse, avg(e) AS mae,
    avg(e / greatest(abs(y), 2.220446049250313e-16::DOUBLE)) * 100 AS mape, avg(e / nullif(abs(y), 0)) * 100 AS mape_nonzero,
    1 - sum(e * e) / nullif(var_pop(y) * count(y), 0) AS r2,
    avg(2 * e / CASE WHEN abs(y) + abs(yhat) = 0 THEN 1 ELSE abs(y) + abs(yhat) END) * 100 AS smape, avg(e) / nullif(avg(step), 0) AS mase
    FROM g GROUP BY 1, 2, 3)"""
)


@query(
    "ev_metrics",
    METRICS_SQL
    + """ SELECT region, category, model_type, n, round(rmse, 6) AS rmse, round(mse, 6) AS mse, round(mae, 6) AS mae,
    CAST(printf('%.8e', mape) AS DOUBLE) AS mape, round(mape_nonzero, 6) AS mape_nonzero, round(r2, 6) AS r2, round(smape, 6) AS smape,
    round(mase, 6) AS mase FROM m""",
)
def ev_metrics(star):
    df = evaluation.forecast_metrics(naive_forecasts(star), MODEL_KEYS)
    df = rounded(df, "rmse", "mse", "mae", "mape_nonzero", "r2", "smape", "mase")
    return df.withColumn("mape", significant(F.col("mape"), 9))


@query(
    "ev_metrics_basic",
    METRICS_SQL
    + " SELECT region, category, model_type, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(mape_nonzero, 6) AS mape FROM m",
)
def ev_metrics_basic(star):
    return rounded(evaluation.basic_metrics(naive_forecasts(star), MODEL_KEYS), "rmse", "mae", "mape")


@query(
    "top_items_low_error",
    METRICS_SQL.replace("category", "department")
    + """ SELECT department, round(avg(mape_nonzero), 6) AS mape FROM m WHERE model_type = 'week_before' GROUP BY 1
    ORDER BY mape, department LIMIT 20""",
)
def top_items_low_error(star):
    keys = ["region", "department"]
    forecasts = naive_forecasts(star, keys).where(F.col("model_type") == "week_before")
    metrics = evaluation.basic_metrics(forecasts, [*keys, "model_type"])
    by_item = rounded(metrics.groupBy("department").agg(F.avg("mape").alias("mape")), "mape")
    return rows.bottom_k(by_item, "mape", ["department"], 20)


@query(
    "ev_compare_models",
    METRICS_SQL
    + """, c AS (SELECT * FROM m WHERE rmse <= (SELECT quantile_cont(rmse, 0.95) FROM m) AND smape <= (SELECT quantile_cont(smape, 0.95) FROM m)),
    q AS (SELECT model_type, quantile_cont(rmse, 0.25) AS q1, quantile_cont(rmse, 0.5) AS q2, quantile_cont(rmse, 0.75) AS q3 FROM c GROUP BY 1)
    SELECT model_type, round(q1, 6) AS q1, round(q2, 6) AS median, round(q3, 6) AS q3, round(min(rmse), 6) AS whisker_low, round(max(rmse), 6) AS whisker_high
    FROM c JOIN q USING (model_type) WHERE rmse BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY model_type, q1, q2, q3""",
)
def ev_compare_models(star):
    metrics = materialise(evaluation.forecast_metrics(naive_forecasts(star), MODEL_KEYS), "metrics")
    kept = rows.cap_by_quantile(metrics, ["rmse", "smape"])
    box = evaluation.compare_models(kept, "rmse")
    return rounded(box, "q1", "median", "q3", "whisker_low", "whisker_high")


@query(
    "ev_cv_summary",
    NUMBERED_SQL
    + """, b AS (SELECT r.*, k AS fold, n - (n // 6) * (5 - k) AS upto, n // 6 AS size FROM r, (SELECT unnest(range(1, 6))::INTEGER AS k)),
    tr AS (SELECT region, category, fold, avg(y) AS yhat FROM b WHERE rn <= upto - size GROUP BY 1, 2, 3),
    te AS (SELECT b.region, b.category, b.fold, sqrt(avg((y - yhat) * (y - yhat))) AS rmse FROM b
      JOIN tr ON b.region = tr.region AND b.category = tr.category AND b.fold = tr.fold WHERE rn > upto - size AND rn <= upto GROUP BY 1, 2, 3)
    SELECT region, category, round(avg(rmse), 6) AS mean, round(stddev_samp(rmse), 6) AS std, round(min(rmse), 6) AS min, round(max(rmse), 6) AS max
    FROM te GROUP BY 1, 2""",
)
def ev_cv_summary(star):
    """Each fold predicts its test days with the training mean."""
    folds = series.folds_expanding(category_series(star), KEYS, 5)
    fold = Window.partitionBy(*KEYS, "fold")
    mean = F.avg(F.when(F.col("split") == "train", F.col("y"))).over(fold)
    test = folds.withColumn("yhat", mean).where(F.col("split") == "test")
    per_fold = evaluation.basic_metrics(test, [*KEYS, "fold"])
    return rounded(evaluation.fold_summary(per_fold, KEYS, "rmse"), "mean", "std", "min", "max")


@query(
    "ev_interval",
    FORECAST_SQL
    + """ SELECT region, category, model_type, round(avg(yhat * 1.2::DOUBLE - yhat * 0.8::DOUBLE), 6) AS interval_width,
    round(avg(CAST(NOT (y BETWEEN yhat * 0.8::DOUBLE AND yhat * 1.2::DOUBLE) AS DOUBLE)), 6) AS miscoverage_rate FROM f GROUP BY 1, 2, 3""",
)
def ev_interval(star):
    bands = naive_forecasts(star).withColumns(
        {"yhat_lower": F.col("yhat") * F.lit(0.8), "yhat_upper": F.col("yhat") * F.lit(1.2)}
    )
    return rounded(evaluation.interval_quality(bands, MODEL_KEYS), "interval_width", "miscoverage_rate")


@query(
    "ev_pinball",
    FORECAST_SQL
    + """ SELECT region, category, model_type, round(avg(greatest(0.9::DOUBLE * (y - yhat), (0.9::DOUBLE - 1) * (y - yhat))), 6) AS pinball
    FROM f GROUP BY 1, 2, 3""",
)
def ev_pinball(star):
    return rounded(evaluation.pinball_loss(naive_forecasts(star), MODEL_KEYS, 0.9), "pinball")


@query(
    "ev_classification",
    FORECAST_SQL
    + """, c AS (SELECT CAST(y > 0 AS INTEGER) AS l, CAST(yhat > 0 AS INTEGER) AS p FROM f),
    k AS (SELECT unnest([0, 1])::INTEGER AS class),
    t AS (SELECT class, count(CASE WHEN l = class AND p = class THEN 1 END) AS tp, count(CASE WHEN l = class THEN 1 END) AS support,
      count(CASE WHEN p = class THEN 1 END) AS pred FROM c, k GROUP BY 1),
    pr AS (SELECT class, coalesce(tp::DOUBLE / nullif(pred, 0), 0) AS precision, coalesce(tp::DOUBLE / nullif(support, 0), 0) AS recall, support FROM t)
    SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall,
      round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0), 6) AS f1, support,
      round((SELECT avg(CAST(l = p AS DOUBLE)) FROM c), 6) AS accuracy FROM pr WHERE support > 0""",
)
def ev_classification(star):
    labelled = naive_forecasts(star).select(
        (F.col("y") > 0).cast("int").alias("label"), (F.col("yhat") > 0).cast("int").alias("prediction")
    )
    report = evaluation.classification_report(labelled, "label", "prediction")
    return rounded(report, "precision", "recall", "f1", "accuracy")
