"""Grouped, ranked and windowed sales queries over the fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tillcast.functions import dates
from tillcast.operators import aggregates, reshape, rows, windows
from tillcast.plans.catalog import query, rounded
from tillcast.sources.star import CATEGORIES, PERIODS, item_is, store_code_is

REGION = "ASIA"
WEEK = 199820
YEAR = 1998
CATEGORY = "PROMO"
DEPARTMENT = "Brand#7"
ITEM = "42"
STORE_CODE = "7"

IN_YEAR_SQL = "date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'"
HAS_EVENT_SQL = "event IS NOT NULL AND event <> ''"


def in_year(year: int = YEAR):
    return F.col("date").between(dt.date(year, 1, 1), dt.date(year, 12, 31))


def in_week(yearweek: int = WEEK):
    """The days of an ISO week as a date range, which prunes the scan."""
    first, last = dates.week_dates(yearweek)
    return F.col("date").between(first, last)


def totals(star, by, where=None):
    return star.summarise(by, where, total_sales=("sum", "sales"))


# --- grouped measures ------------------------------------------------------------------------


@query(
    "agg_sales_stats",
    """WITH {fact} SELECT min(sales) AS min_sales, max(sales) AS max_sales,
       avg(sales) AS avg_sales, CAST(sum(sales) AS BIGINT) AS total_sales,
       count(*) AS n_rows FROM fact""",
)
def agg_sales_stats(star):
    df = star.fact("sales").agg(
        F.min("sales").alias("min_sales"),
        F.max("sales").alias("max_sales"),
        F.avg("sales").alias("avg_sales"),
        F.sum("sales").alias("total_sales"),
        F.count("*").alias("n_rows"),
    )
    return df


def _total_query(name: str, keys: list[str], order: str, condition: str = "true", where=None):
    """Total sales by ``keys`` in a stated order. ``where`` builds the filter when run: columns
    need a session, and registering must not."""
    shown = ", ".join("CAST(date AS VARCHAR) AS date" if k == "date" else k for k in keys)
    sql = (
        f"WITH {{fact}} SELECT {shown}, CAST(sum(sales) AS BIGINT) AS total_sales "
        f"FROM fact WHERE {condition} GROUP BY {', '.join(f'fact.{k}' for k in keys)}"
    )
    parsed = [(part.split(" ")[0], part.endswith(" DESC")) for part in order.split(", ")]

    @query(name, sql)
    def build(star):
        sort = [F.desc(c) if down else F.asc(c) for c, down in parsed]
        return totals(star, keys, where() if where else None).orderBy(*sort)


_total_query("agg_by_category", ["category"], "total_sales DESC, category")
_total_query("agg_by_store", ["store"], "total_sales DESC, store")
_total_query("agg_by_region", ["region"], "total_sales DESC, region")
_total_query("agg_by_date", ["date"], "date")
_total_query("agg_region_item", ["region", "item"], "region, total_sales DESC, item")
_total_query("agg_store_item", ["store", "item"], "store, total_sales DESC, item")
_total_query("agg_region_dept", ["region", "department"], "region, department")
_total_query("srt_multi_key", ["store", "category"], "store, total_sales DESC, category")
_total_query(
    "agg_by_event", ["event"], "total_sales DESC, event", HAS_EVENT_SQL, rows.event_present
)
_total_query(
    "agg_event_category",
    ["event", "category"],
    "event, total_sales DESC, category",
    HAS_EVENT_SQL,
    rows.event_present,
)


@query(
    "agg_by_weekday",
    """WITH {fact} SELECT dayname(date) AS day_name, CAST(sum(sales) AS BIGINT) AS total_sales
       FROM fact GROUP BY 1""",
)
def agg_by_weekday(star):
    by_day = totals(star, ["date"]).groupBy(
        dates.day_name(F.col("date")).alias("day_name"), dates.day_of_week(F.col("date")).alias("n")
    )
    return by_day.agg(F.sum("total_sales").alias("total_sales")).orderBy("n").drop("n")


@query(
    "agg_price_mean_region",
    """WITH {fact} SELECT region, CAST(sum(sell_price) AS DOUBLE) / count(sell_price) AS mean_price
       FROM fact GROUP BY region""",
)
def agg_price_mean_region(star):
    df = star.summarise(["region"], mean_price=("avg", "sell_price"))
    return df.orderBy(F.desc("mean_price"))


@query(
    "agg_sales_std_category",
    """WITH {fact} SELECT category, round(stddev_samp(sales), 6) AS sales_std
       FROM fact GROUP BY category""",
)
def agg_sales_std_category(star):
    df = star.summarise(["category"], sales_std=("std", "sales"))
    return rounded(df, "sales_std").orderBy(F.desc("sales_std"))


@query(
    "agg_price_std_store",
    """WITH {fact} SELECT store, round(stddev_samp(sell_price), 6) AS price_std
       FROM fact GROUP BY store""",
)
def agg_price_std_store(star):
    df = star.summarise(["store"], price_std=("std", "sell_price"))
    return rounded(df, "price_std").orderBy(F.desc("price_std"))


@query(
    "agg_category_month",
    """WITH {fact} SELECT category, CAST(month(date) AS INTEGER) AS month,
       CAST(sum(sales) AS BIGINT) AS total_sales FROM fact GROUP BY 1, 2""",
)
def agg_category_month(star):
    daily = totals(star, ["category", "date"])
    return daily.groupBy("category", F.month("date").alias("month")).agg(
        F.sum("total_sales").alias("total_sales")
    )


DECEMBER_SQL = """CASE WHEN month(date) = 12 AND day(date) = 23 THEN 'Natal D-2'
  WHEN month(date) = 12 AND day(date) = 24 THEN 'Natal D-1'
  WHEN month(date) = 12 AND day(date) = 26 THEN 'Boxing Day' ELSE event END"""

EVENT_YEAR_SQL = f"""WITH {{fact}}, by_year AS (
  SELECT CAST(year(date) AS INTEGER) AS year, event, CAST(sum(sales) AS BIGINT) AS total_sales
  FROM (SELECT date, sales, {DECEMBER_SQL} AS event FROM fact)
  WHERE event IS NOT NULL AND event <> '' GROUP BY 1, 2)"""


def _events_by_year(star):
    daily = totals(star, ["date", "event"])
    named = daily.withColumn("event", dates.december_events(F.col("date"), F.col("event")))
    return (
        named.where(rows.event_present())
        .groupBy(F.year("date").alias("year"), "event")
        .agg(F.sum("total_sales").alias("total_sales"))
    )


@query("agg_event_year", EVENT_YEAR_SQL + " SELECT * FROM by_year")
def agg_event_year(star):
    return _events_by_year(star)


@query(
    "agg_event_stats",
    EVENT_YEAR_SQL
    + """ SELECT event, round(avg(total_sales), 2) AS mean_sales,
       round(stddev_samp(total_sales), 2) AS std_sales,
       string_agg(CAST(year AS VARCHAR), ', ' ORDER BY year) AS years
       FROM by_year GROUP BY event""",
)
def agg_event_stats(star):
    return aggregates.event_stats(_events_by_year(star))


@query(
    "agg_max_sales",
    """WITH {fact} SELECT region, category_price, store, max(sales) AS max_sales
       FROM fact GROUP BY 1, 2, 3""",
)
def agg_max_sales(star):
    return star.summarise(["region", "category_price", "store"], max_sales=("max", "sales"))


@query(
    "agg_max_price",
    """WITH {fact} SELECT region, store, CAST(max(sell_price) AS DOUBLE) AS max_price
       FROM fact GROUP BY 1, 2""",
)
def agg_max_price(star):
    return star.summarise(["region", "store"], max_price=("max", "sell_price"))


@query(
    "agg_std_store_week",
    """WITH {fact} SELECT region, yearweek, store, round(stddev_samp(sales), 6) AS sales_std
       FROM fact GROUP BY 1, 2, 3""",
)
def agg_std_store_week(star):
    df = star.summarise(["region", "yearweek", "store"], sales_std=("std", "sales"))
    return rounded(df, "sales_std")


@query(
    "agg_avg_region_week",
    f"""WITH {{fact}} SELECT region, yearweek, avg(sales) AS average_sales
       FROM fact WHERE {IN_YEAR_SQL} GROUP BY 1, 2""",
)
def agg_avg_region_week(star):
    df = star.summarise(["region", "yearweek"], in_year(), average_sales=("avg", "sales"))
    return df


@query(
    "agg_std_dept",
    f"""WITH {{fact}} SELECT department, round(stddev_samp(sales), 6) AS sales_std
       FROM fact WHERE {IN_YEAR_SQL} GROUP BY 1""",
)
def agg_std_dept(star):
    df = star.summarise(["department"], in_year(), sales_std=("std", "sales"))
    return rounded(df, "sales_std")


@query(
    "agg_corr_region",
    """WITH {fact} SELECT region, round(corr(sales, sell_price), 6) + 0.0 AS sales_price_corr
       FROM fact GROUP BY 1""",
)
def agg_corr_region(star):
    df = star.summarise(["region"], sales_price_corr=("corr", ("sales", "sell_price")))
    return rounded(df, "sales_price_corr")


@query(
    "agg_corr_global",
    f"""WITH {{fact}} SELECT round(corr(sales, sell_price), 6) + 0.0 AS sales_price_corr
       FROM fact WHERE {IN_YEAR_SQL}""",
)
def agg_corr_global(star):
    df = aggregates.correlation(
        star.fact("sales", "sell_price", where=in_year()), [], "sales", "sell_price",
        "sales_price_corr",
    )
    return rounded(df, "sales_price_corr")


@query(
    "agg_avg_store_week",
    f"""WITH {{fact}} SELECT region, yearweek, store, avg(sales) AS average_sales
       FROM fact WHERE {IN_YEAR_SQL} GROUP BY 1, 2, 3""",
)
def agg_avg_store_week(star):
    df = star.summarise(["region", "yearweek", "store"], in_year(), average_sales=("avg", "sales"))
    return df


@query(
    "agg_avg_price_cat_store",
    """WITH {fact} SELECT category, store_code, CAST(sum(sell_price) AS DOUBLE) / count(sell_price) AS avg_sell_price
       FROM fact GROUP BY 1, 2""",
)
def agg_avg_price_cat_store(star):
    df = star.summarise(["category", "store_code"], avg_sell_price=("avg", "sell_price"))
    return df


@query(
    "agg_avg_price_week",
    """WITH {fact} SELECT category, region, yearweek, CAST(sum(sell_price) AS DOUBLE) / count(sell_price)
       AS avg_sell_price FROM fact GROUP BY 1, 2, 3""",
)
def agg_avg_price_week(star):
    return star.summarise(["category", "region", "yearweek"], avg_sell_price=("avg", "sell_price"))


@query(
    "agg_describe",
    """WITH {fact}, v AS (
         SELECT 'sales' AS measure, CAST(sales AS DOUBLE) AS x FROM fact
         UNION ALL SELECT 'sell_price', CAST(sell_price AS DOUBLE) FROM fact)
       SELECT measure, count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std,
         round(min(x), 6) AS min, round(quantile_cont(x, 0.25), 6) AS p25,
         round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.75), 6) AS p75,
         round(max(x), 6) AS max
       FROM v GROUP BY measure""",
)
def agg_describe(star):
    values = star.fact("sales", "sell_price").select(
        F.col("sales").cast("double").alias("sales"),
        F.col("sell_price").cast("double").alias("sell_price"),
    )
    long = values.unpivot([], ["sales", "sell_price"], "measure", "x")
    df = aggregates.describe(long, "x", ["measure"])
    return rounded(df, "mean", "std", "min", "p25", "p50", "p75", "max")


@query(
    "agg_item_price_profile",
    """WITH {fact} SELECT item, CAST(sum(sales) AS BIGINT) AS total_sales,
         CAST(sum(sell_price) AS DOUBLE) / count(sell_price) AS average_price,
         round(coalesce(stddev_samp(sell_price), 0), 6) AS price_std
       FROM fact GROUP BY item""",
)
def agg_item_price_profile(star):
    df = aggregates.price_profile(star, "item")
    return rounded(df, "price_std")


# Equal-width bins of total sales stand for a cluster assignment that SQL can repeat.
BINNED_STORES_SQL = """WITH {fact}, s AS (
  SELECT store, sum(sales)::BIGINT AS total_sales, CAST(sum(sell_price) AS DOUBLE) / count(sell_price) AS average_price,
    coalesce(stddev_samp(sell_price), 0) AS price_std FROM fact GROUP BY store),
 lim AS (SELECT min(total_sales)::DOUBLE AS lo, max(total_sales)::DOUBLE AS hi FROM s),
 c AS (SELECT s.*, CAST(least(coalesce(floor((total_sales - lo) / nullif((hi - lo) / 3.0::DOUBLE, 0)), 0), 2)
   AS INTEGER) AS cluster FROM s, lim)"""


def _binned_stores(star):
    profile = aggregates.price_profile(star, "store")
    return aggregates.assign_bins(profile, "total_sales", 3, "cluster")


@query(
    "agg_cluster_stats",
    BINNED_STORES_SQL
    + """ SELECT cluster,
       round(avg(total_sales), 2) AS total_sales_mean, round(stddev_samp(total_sales), 2) AS total_sales_std,
       round(avg(average_price), 2) AS average_price_mean,
       round(stddev_samp(average_price), 2) AS average_price_std,
       round(avg(price_std), 2) AS price_std_mean, round(stddev_samp(price_std), 2) AS price_std_std,
       count(*) AS members FROM c GROUP BY cluster""",
)
def agg_cluster_stats(star):
    return aggregates.cluster_stats(
        _binned_stores(star), ["total_sales", "average_price", "price_std"]
    )


@query(
    "agg_cluster_mean",
    BINNED_STORES_SQL + " SELECT cluster, round(avg(total_sales), 6) AS mean_sales FROM c GROUP BY 1",
)
def agg_cluster_mean(star):
    df = aggregates.group_measures(
        _binned_stores(star), ["cluster"], mean_sales=("avg", "total_sales")
    )
    return rounded(df, "mean_sales")


@query(
    "flt_cluster_members",
    BINNED_STORES_SQL + " SELECT cluster, store, total_sales FROM c WHERE cluster = 1",
)
def flt_cluster_members(star):
    return _binned_stores(star).where(F.col("cluster") == 1).select("cluster", "store", "total_sales")


@query(
    "agg_date_item",
    """WITH {fact} SELECT CAST(date AS VARCHAR) AS date, item, CAST(sum(sales) AS BIGINT) AS sales,
       CAST(sum(sell_price) AS DOUBLE) / count(sell_price) AS sell_price
       FROM fact GROUP BY fact.date, item""",
)
def agg_date_item(star):
    return star.summarise(["date", "item"], sales=("sum", "sales"), sell_price=("avg", "sell_price"))


@query(
    "agg_value_counts",
    """WITH {fact} SELECT sales, count(*) AS rows FROM fact GROUP BY sales
       ORDER BY rows DESC, sales LIMIT 50""",
)
def agg_value_counts(star):
    return aggregates.value_counts(star.fact("sales"), "sales")


@query(
    "agg_histogram",
    """WITH {fact}, s AS (SELECT store, CAST(sum(sales) AS DOUBLE) AS x FROM fact GROUP BY store),
       lim AS (SELECT min(x) AS lo, max(x) AS hi FROM s)
       SELECT CAST(least(coalesce(floor((x - lo) / nullif((hi - lo) / 20.0::DOUBLE, 0)), 0), 19) AS INTEGER) AS bin,
         count(*) AS rows FROM s, lim GROUP BY 1""",
)
def agg_histogram(star):
    return aggregates.histogram(totals(star, ["store"]), "total_sales", 20)


@query(
    "agg_histogram_sales",
    """WITH {fact}, lim AS (SELECT min(sales)::DOUBLE AS lo, max(sales)::DOUBLE AS hi FROM fact)
       SELECT CAST(least(coalesce(floor((sales - lo) / nullif((hi - lo) / 10.0::DOUBLE, 0)), 0), 9) AS INTEGER) AS bin,
         count(*) AS rows FROM fact, lim GROUP BY 1""",
)
def agg_histogram_sales(star):
    return aggregates.histogram(star.fact("sales"), "sales", 10)


# --- shares, ranks, running values -----------------------------------------------------------


def _share_query(name: str, keys: list[str], within: list[str]):
    columns, group = ", ".join(keys), ", ".join(within)
    sql = f"""WITH {{fact}} SELECT {columns}, CAST(sum(sales) AS BIGINT) AS total_sales,
      round(CAST(sum(sales) AS DOUBLE) / CAST(sum(sum(sales)) OVER (PARTITION BY {group}) AS DOUBLE) * 100, 6)
        AS contribution_pct
      FROM fact GROUP BY {columns}"""

    @query(name, sql)
    def build(star):
        summary = totals(star, keys)
        df = windows.share_of_group(summary, within, "total_sales", "contribution_pct")
        return rounded(df, "contribution_pct")


_share_query("win_share_store", ["region", "department", "store"], ["region", "department"])
_share_query(
    "win_share_category_pair", ["region", "yearweek", "category", "category_price"],
    ["region", "yearweek"],
)
_share_query("win_share_category", ["region", "yearweek", "category"], ["region", "yearweek"])
_share_query("win_share_store_week", ["region", "yearweek", "store"], ["region"])


@query(
    "win_top5_item_share",
    f"""WITH {{fact}} SELECT region, yearweek, item, CAST(sum(sales) AS BIGINT) AS total_sales,
      round(CAST(sum(sales) AS DOUBLE) / CAST(sum(sum(sales)) OVER (PARTITION BY region, yearweek) AS DOUBLE) * 100, 6)
        AS contribution_pct
      FROM fact WHERE region = '{REGION}' AND yearweek = {WEEK} GROUP BY 1, 2, 3
      ORDER BY total_sales DESC, item LIMIT 5""",
)
def win_top5_item_share(star):
    summary = totals(star, ["region", "yearweek", "item"], in_week()).where(F.col("region") == REGION)
    shares = windows.share_of_group(summary, ["region", "yearweek"], "total_sales", "contribution_pct")
    return rounded(rows.top_k(shares, "total_sales", ["item"], 5), "contribution_pct")


@query(
    "win_rank_event_dept",
    """WITH {fact} SELECT event, department, CAST(sum(sales) AS BIGINT) AS total_sales,
      CAST(rank() OVER (PARTITION BY event ORDER BY sum(sales) DESC) AS INTEGER) AS sales_rank
      FROM fact GROUP BY 1, 2""",
)
def win_rank_event_dept(star):
    summary = totals(star, ["event", "department"])
    ranked = windows.rank_within(summary, ["event"], "total_sales", "sales_rank")
    return ranked.orderBy("event", "sales_rank", "department")


@query(
    "win_rank_category_week",
    """WITH {fact} SELECT yearweek, category, CAST(sum(sales) AS BIGINT) AS total_sales,
      CAST(rank() OVER (PARTITION BY yearweek ORDER BY sum(sales) DESC) AS INTEGER) AS sales_rank
      FROM fact GROUP BY 1, 2""",
)
def win_rank_category_week(star):
    summary = totals(star, ["yearweek", "category"])
    return windows.rank_within(summary, ["yearweek"], "total_sales", "sales_rank")


@query(
    "win_cumulative",
    """WITH {fact} SELECT store_code, category_price, CAST(date AS VARCHAR) AS date,
      CAST(sum(sales) OVER (PARTITION BY store_code, category_price ORDER BY fact.date) AS BIGINT)
        AS cumulative_sales FROM fact""",
)
def win_cumulative(star):
    lines = star.fact("store_code", "category_price", "date", "sales")
    df = windows.cumulative_by_date(
        lines, ["store_code", "category_price"], "date", "sales", "cumulative_sales"
    )
    return df.drop("sales")


@query(
    "win_cumulative_store",
    """WITH {fact} SELECT store_code, CAST(date AS VARCHAR) AS date,
      CAST(sum(sales) OVER (PARTITION BY store_code ORDER BY fact.date) AS BIGINT)
        AS cumulative_sales FROM fact""",
)
def win_cumulative_store(star):
    lines = star.fact("store_code", "date", "sales")
    df = windows.cumulative_by_date(lines, ["store_code"], "date", "sales", "cumulative_sales")
    return df.drop("sales")


@query(
    "win_moving_avg_7",
    """WITH {fact}, daily AS (
        SELECT region, date, sum(sales)::BIGINT AS total_sales FROM fact GROUP BY 1, 2)
      SELECT region, CAST(date AS VARCHAR) AS date, total_sales,
        round(avg(total_sales) OVER (PARTITION BY region ORDER BY daily.date
          ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS moving_avg_sales FROM daily""",
)
def win_moving_avg_7(star):
    daily = totals(star, ["region", "date"])
    df = windows.moving_average(daily, ["region"], "date", "total_sales", 7, "moving_avg_sales")
    return rounded(df, "moving_avg_sales")


@query(
    "win_lag_change",
    """WITH {fact}, weekly AS (
        SELECT region, yearweek, sum(sales)::BIGINT AS total_sales FROM fact
        WHERE date >= DATE '1996-01-01' GROUP BY 1, 2),
      p AS (SELECT *, lag(total_sales, 1, 0) OVER (PARTITION BY region ORDER BY yearweek) AS prev FROM weekly)
      SELECT region, yearweek, total_sales,
        round((total_sales - prev)::DOUBLE * 100 / nullif(prev, 0), 6) + 0.0 AS change_pct FROM p""",
)
def win_lag_change(star):
    weekly = totals(star, ["region", "yearweek"], F.col("date") >= F.lit("1996-01-01").cast("date"))
    df = windows.lag_change(weekly, ["region"], "yearweek", "total_sales", "change_pct")
    return rounded(df, "change_pct")


@query(
    "win_yoy_store",
    """WITH {fact}, weekly AS (
        SELECT region, yearweek, store, sum(sales)::BIGINT AS total_sales FROM fact GROUP BY 1, 2, 3)
      SELECT a.region, a.yearweek, a.store, a.total_sales,
        round((a.total_sales - b.total_sales)::DOUBLE * 100 / nullif(b.total_sales, 0), 6) + 0.0 AS yoy_pct
      FROM weekly a LEFT JOIN weekly b
        ON a.region = b.region AND a.store = b.store AND a.yearweek = b.yearweek + 100""",
)
def win_yoy_store(star):
    weekly = totals(star, ["region", "yearweek", "store"])
    df = windows.year_on_year(weekly, ["region", "store"], "yearweek", "total_sales", "yoy_pct")
    return rounded(df, "yoy_pct")


REGION_DAILY_SQL = """WITH {fact}, daily AS (
  SELECT region, date, sum(sales)::BIGINT AS sales, CAST(sum(sell_price) AS DOUBLE) / count(sell_price) AS sell_price
  FROM fact GROUP BY 1, 2)"""


def _region_daily(star):
    return star.summarise(
        ["region", "date"], sales=("sum", "sales"), sell_price=("avg", "sell_price")
    )


@query(
    "win_lags",
    REGION_DAILY_SQL
    + """ SELECT region, CAST(date AS VARCHAR) AS date, sales,
      coalesce(lag(sales, 1) OVER w, -1) AS lag_1, coalesce(lag(sales, 7) OVER w, -1) AS lag_7
      FROM daily WINDOW w AS (PARTITION BY region ORDER BY daily.date)""",
)
def win_lags(star):
    daily = _region_daily(star).drop("sell_price")
    return windows.lags(daily, ["region"], "date", "sales", [1, 7]).fillna(-1, ["lag_1", "lag_7"])


@query(
    "win_rolling",
    REGION_DAILY_SQL
    + """ SELECT region, CAST(date AS VARCHAR) AS date,
      CASE WHEN count(sales) OVER w = 7 THEN round(avg(sales) OVER w, 6) END AS rolling_mean_7,
      CASE WHEN count(sales) OVER w = 7 THEN round(stddev_samp(sales) OVER w, 6) END AS rolling_std_7
      FROM daily WINDOW w AS (PARTITION BY region ORDER BY daily.date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
def win_rolling(star):
    daily = _region_daily(star).drop("sell_price")
    df = windows.rolling_stats(daily, ["region"], "date", "sales", 7).drop("sales")
    return rounded(df, "rolling_mean_7", "rolling_std_7")


@query(
    "win_pct_change",
    REGION_DAILY_SQL
    + """ SELECT region, CAST(date AS VARCHAR) AS date,
      round(sales::DOUBLE / nullif(lag(sales) OVER w, 0) - 1, 6) + 0.0 AS sales_pct_change,
      round(sell_price / nullif(lag(sell_price) OVER w, 0) - 1, 6) + 0.0 AS price_pct_change
      FROM daily WINDOW w AS (PARTITION BY region ORDER BY daily.date)""",
)
def win_pct_change(star):
    df = _region_daily(star).select(
        "region",
        "date",
        windows.pct_change("sales", ["region"], "date").alias("sales_pct_change"),
        windows.pct_change("sell_price", ["region"], "date").alias("price_pct_change"),
    )
    return rounded(df, "sales_pct_change", "price_pct_change")


@query(
    "win_top_n_per_group",
    """WITH {fact}, t AS (SELECT store, item, sum(sales)::BIGINT AS total_sales FROM fact GROUP BY 1, 2),
      r AS (SELECT *, row_number() OVER (PARTITION BY store ORDER BY total_sales DESC, item) AS rank FROM t)
      SELECT store, item, total_sales, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""",
)
def win_top_n_per_group(star):
    return windows.top_n_per_group(totals(star, ["store", "item"]), ["store"], "total_sales", "item", 10)


# --- top-k reports ---------------------------------------------------------------------------


@query(
    "top_items_sum",
    f"""WITH {{fact}} SELECT item, CAST(sum(sales) AS BIGINT) AS total_sales FROM fact
      WHERE region = '{REGION}' AND yearweek = {WEEK} GROUP BY 1 ORDER BY total_sales DESC, item LIMIT 5""",
)
def top_items_sum(star):
    summary = totals(star, ["region", "item"], in_week()).where(F.col("region") == REGION)
    return rows.top_k(summary.drop("region"), "total_sales", ["item"], 5)


@query(
    "top_stores_avg",
    f"""WITH {{fact}} SELECT region, yearweek, store, avg(sales) AS avg_sales FROM fact
      WHERE region = '{REGION}' AND yearweek = {WEEK} GROUP BY 1, 2, 3
      ORDER BY avg_sales DESC, store LIMIT 5""",
)
def top_stores_avg(star):
    summary = star.summarise(["region", "yearweek", "store"], in_week(), avg_sales=("avg", "sales"))
    summary = summary.where(F.col("region") == REGION)
    return rows.top_k(summary, "avg_sales", ["store"], 5)


@query(
    "top_items_price",
    f"""WITH {{fact}} SELECT item, CAST(sum(sell_price) AS DOUBLE) / count(sell_price) AS average_price FROM fact
      WHERE {IN_YEAR_SQL} GROUP BY 1 ORDER BY average_price DESC, item LIMIT 5""",
)
def top_items_price(star):
    summary = star.summarise(["item"], in_year(), average_price=("avg", "sell_price"))
    return rows.top_k(summary, "average_price", ["item"], 5)


@query(
    "top_regions_category",
    f"""WITH {{fact}} SELECT region, CAST(sum(sales) AS BIGINT) AS total_sales FROM fact
      WHERE category = '{CATEGORY}' GROUP BY 1 ORDER BY total_sales DESC, region LIMIT 3""",
)
def top_regions_category(star):
    only = F.col("category") == CATEGORY
    summary = star.summarise(["region"], item_where=only, total_sales=("sum", "sales"))
    return rows.top_k(summary, "total_sales", ["region"], 3)


@query(
    "top_stores_price_dept",
    f"""WITH {{fact}} SELECT store_code, CAST(sum(sell_price) AS DOUBLE) / count(sell_price) AS average_price FROM fact
      WHERE department = '{DEPARTMENT}' GROUP BY 1 ORDER BY average_price DESC, store_code LIMIT 5""",
)
def top_stores_price_dept(star):
    only = F.col("department") == DEPARTMENT
    summary = star.summarise(["store_code"], item_where=only, average_price=("avg", "sell_price"))
    return rows.top_k(summary, "average_price", ["store_code"], 5)


@query(
    "top_events_item",
    f"""WITH {{fact}} SELECT event, CAST(sum(sales) AS BIGINT) AS total_sales FROM fact
      WHERE item = '{ITEM}' GROUP BY 1 ORDER BY total_sales DESC, event NULLS FIRST LIMIT 3""",
)
def top_events_item(star):
    summary = totals(star, ["event"], item_is(ITEM))
    return rows.top_k(summary, "total_sales", ["event"], 3)


@query(
    "top_categories_store",
    f"""WITH {{fact}} SELECT category, avg(sales) AS avg_sales FROM fact
      WHERE store_code = '{STORE_CODE}' GROUP BY 1 ORDER BY avg_sales DESC, category LIMIT 5""",
)
def top_categories_store(star):
    summary = star.summarise(["category"], store_code_is(STORE_CODE), avg_sales=("avg", "sales"))
    return rows.top_k(summary, "avg_sales", ["category"], 5)


@query(
    "top_items_global",
    """WITH {fact}, top AS (SELECT item, sum(sales) AS t FROM fact GROUP BY item ORDER BY t DESC, item LIMIT 10)
      SELECT item, CAST(date AS VARCHAR) AS date, store, sales FROM fact
      WHERE item IN (SELECT item FROM top)""",
)
def top_items_global(star):
    best = rows.top_k(totals(star, ["item"]), "total_sales", ["item"], 10)
    return rows.rows_of_items(star.fact("item", "date", "store", "sales"), best, "item")


# --- wide reports ----------------------------------------------------------------------------


def _wide_sql(column: str, values: list[str]) -> str:
    """SQL columns of the sums for each named value, and of all others."""
    parts = [(f"{column} = '{v}'", v) for v in values]
    named = ", ".join(f"'{v}'" for v in values)
    parts.append((f"{column} IS NULL OR {column} NOT IN ({named})", reshape.OTHER))
    return ", ".join(
        f'coalesce(sum(sales) FILTER (WHERE {condition}), 0)::BIGINT AS "{name}"'
        for condition, name in parts
    )


# Stores and items grow with the data, so their reports are long: no column for each.


@query(
    "rsh_pivot_cat_store",
    "WITH {fact} SELECT category, store, sum(sales)::BIGINT AS total_sales FROM fact GROUP BY 1, 2",
)
def rsh_pivot_cat_store(star):
    return totals(star, ["category", "store"])


@query(
    "rsh_pivot_store_cat",
    "WITH {fact} SELECT store, " + _wide_sql("category", CATEGORIES) + " FROM fact GROUP BY store",
)
def rsh_pivot_store_cat(star):
    by_both = totals(star, ["category", "store"])
    return reshape.pivot_sum(by_both, ["store"], "category", "total_sales", CATEGORIES)


@query(
    "rsh_pivot_region_period",
    "WITH {fact} SELECT region, "
    + _wide_sql("strftime(date, '%Y_%m')", PERIODS)
    + " FROM fact GROUP BY region",
)
def rsh_pivot_region_period(star):
    monthly = totals(star, ["region", "date"]).withColumn("period", F.date_format("date", "yyyy_MM"))
    return reshape.pivot_sum(monthly, ["region"], "period", "total_sales", PERIODS)


@query(
    "rsh_pivot_date_item",
    """WITH {fact}, top AS (SELECT item, sum(sales) AS t FROM fact GROUP BY item ORDER BY t DESC, item LIMIT 5)
      SELECT CAST(date AS VARCHAR) AS date, item, sum(sales)::BIGINT AS total_sales
        FROM fact WHERE item IN (SELECT item FROM top) GROUP BY fact.date, item""",
)
def rsh_pivot_date_item(star):
    best = rows.top_k(totals(star, ["item"]), "total_sales", ["item"], 5)
    return rows.rows_of_items(totals(star, ["date", "item"]), best, "item")


@query(
    "rsh_pivot_date_cat",
    "WITH {fact} SELECT CAST(date AS VARCHAR) AS date, "
    + _wide_sql("category", CATEGORIES)
    + " FROM fact GROUP BY fact.date",
)
def rsh_pivot_date_cat(star):
    by_both = totals(star, ["date", "category"])
    return reshape.pivot_sum(by_both, ["date"], "category", "total_sales", CATEGORIES)
