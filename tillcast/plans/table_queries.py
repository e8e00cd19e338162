"""Sources, sinks, projections, filters, joins, set operations, reshaping and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast import schemas
from tillcast.functions import dates, scalars
from tillcast.operators import aggregates, joins, reshape, rows, series, windows
from tillcast.plans.catalog import query, rounded
from tillcast.plans.retail_queries import (
    CATEGORY, DEPARTMENT, HAS_EVENT_SQL, IN_YEAR_SQL, ITEM, REGION, STORE_CODE, WEEK, in_week,
    in_year, totals,
)
from tillcast.sources import files, sinks
from tillcast.sources.shared import materialise, new_path
from tillcast.sources.star import CALENDAR_EVENTS, REGIONS, item_is, store_code_is

# One row per region, category and month with the days of the month as columns d_1 .. d_31.
WIDE_DAYS = [f"d_{i}" for i in range(1, 32)]
WIDE_SQL = """WITH {fact}, long AS (
  SELECT region, category, strftime(date, '%Y_%m') AS period, 'd_' || day(date) AS d,
    sum(sales)::INTEGER AS sales FROM fact GROUP BY 1, 2, 3, 4)"""


def _wide_sales(star):
    daily = totals(star, ["region", "category", "date"]).select(
        "region",
        "category",
        F.date_format("date", "yyyy_MM").alias("period"),
        F.concat(F.lit("d_"), F.dayofmonth("date")).alias("d"),
        F.col("total_sales").cast("int").alias("sales"),
    )
    return reshape.pivot_sum(
        daily, ["region", "category", "period"], "d", "sales", WIDE_DAYS, fill=None, other=False
    ).select("region", "category", "period", *[F.col(d).cast("int").alias(d) for d in WIDE_DAYS])


# --- sources ---------------------------------------------------------------------------------


@query("src_csv_wide", WIDE_SQL + " SELECT d, count(*) AS n, sum(sales)::BIGINT AS total FROM long GROUP BY d")
def src_csv_wide(star):
    path = new_path(star.spark, "wide-csv")
    wide = _wide_sales(star)
    wide.write.csv(path, header=True)
    read = star.spark.read.schema(wide.schema).csv(path, header=True)
    sums = [F.struct(F.lit(d).alias("d"), F.count(d).alias("n"), F.sum(d).alias("total")) for d in files.day_columns(read)]
    return read.agg(F.array(*sums).alias("days")).select(F.inline("days"))


@query(
    "src_csv_dates",
    """WITH {fact} SELECT DISTINCT CAST(date AS VARCHAR) AS date, 'd_' || (date - DATE '1995-01-01') AS d,
       event, yearweek FROM fact""",
)
def src_csv_dates(star):
    path = new_path(star.spark, "calendar-csv")
    _calendar(star).select("date", "d", "event").write.csv(path, header=True)
    return files.read_calendar(star.spark, path)


@query(
    "src_csv_lenient",
    """WITH {fact} SELECT store, CAST(sum(sales) AS INTEGER) AS total_sales FROM fact GROUP BY store
       HAVING sum(sales) % 7 <> 0""",
)
def src_csv_lenient(star):
    """Some lines get text where a number belongs; the reader drops exactly those."""
    path = new_path(star.spark, "lenient-csv")
    spoiled = totals(star, ["store"]).select(
        "store",
        F.when(F.col("total_sales") % 7 == 0, F.lit("n/a"))
        .otherwise(F.col("total_sales").cast("string"))
        .alias("total_sales"),
    )
    spoiled.write.csv(path, header=True)
    schema = T.StructType.fromDDL("store string, total_sales int")
    return files.read_csv_lenient(star.spark, path, schema)


@query("src_parquet", "SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders")
def src_parquet(star):
    path = new_path(star.spark, "orders")
    sinks.write_repartitioned(star.table("orders"), path, 4)
    df = files.read_parquet(star.spark, path)
    return rounded(df.agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total")), "total", digits=2)


@query(
    "src_table_query",
    """WITH {fact} SELECT region, CAST(sum(sales) AS BIGINT) AS total_sales FROM fact GROUP BY region""",
)
def src_table_query(star):
    sql = "SELECT region, sum(sales) AS total_sales FROM sales_fact GROUP BY region"
    return files.query_table(star.spark, sql, {"sales_fact": star.fact("region", "sales")})


@query(
    "src_sample",
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 10""",
)
def src_sample(star):
    orders = star.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return files.sample_rows(orders, ["o_orderkey"], 10)


@query(
    "src_year_slices",
    """WITH {fact} SELECT CAST(year(date) AS INTEGER) AS year, count(*) AS n, CAST(sum(sales) AS BIGINT) AS total_sales
       FROM fact WHERE year(date) BETWEEN 1996 AND 2000 GROUP BY 1""",
)
def src_year_slices(star):
    lines = star.fact("date", "sales", where=files.year_range(1996, 2000))
    return lines.groupBy(F.year("date").alias("year")).agg(
        F.count("*").alias("n"), F.sum("sales").alias("total_sales")
    )


# --- sinks: written, read back and compared with what was to be written ----------------------


@query("snk_parquet", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def snk_parquet(star):
    path = new_path(star.spark, "orders")
    sinks.write_parquet(star.table("orders"), path, ["o_orderstatus"])
    return star.spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("snk_repartition", "SELECT 15::BIGINT AS files, count(*) AS rows FROM lineitem")
def snk_repartition(star):
    path = new_path(star.spark, "lines")
    sinks.write_repartitioned(star.table("lineitem"), path, 15)
    files_read = star.spark.read.parquet(path).withColumn("file", F.input_file_name())
    by_file = files_read.groupBy("file").agg(F.count("*").alias("rows"))
    return by_file.agg(F.count("*").alias("files"), F.sum("rows").alias("rows"))


@query(
    "snk_table_mode",
    """WITH {fact} SELECT CAST(year(date) AS INTEGER) AS year, count(*) AS n,
       CAST(sum(CASE WHEN year(date) = 1999 THEN sales + 1 ELSE sales END) AS BIGINT) AS total_sales
       FROM fact GROUP BY 1""",
)
def snk_table_mode(star):
    """Write everything, then load one year again with other values: only that year changes."""
    path = new_path(star.spark, "fact-by-year")
    fact = star.fact("item", "store_code", "date", "sales")
    sinks.write_by_year(fact, path, replace_all=True)
    again = star.fact("item", "store_code", "date", "sales", where=files.year_range(1999))
    sinks.write_by_year(again.withColumn("sales", F.col("sales") + 1), path, replace_all=False)
    return star.spark.read.parquet(path).groupBy("year").agg(
        F.count("*").alias("n"), F.sum("sales").alias("total_sales")
    )


@query(
    "snk_forecast_append",
    """WITH {fact} SELECT region, count(*) AS n, count(*) // 2 AS with_model, CAST(sum(total) AS DOUBLE) AS total
       FROM (SELECT region, date, sum(sales) AS total FROM fact GROUP BY 1, 2
         UNION ALL SELECT region, date, sum(sales) FROM fact GROUP BY 1, 2) GROUP BY region""",
)
def snk_forecast_append(star):
    """Append twice, the second time with a new column; the read merges both schemas."""
    path = new_path(star.spark, "forecasts")
    frame = totals(star, ["region", "date"]).select(
        "date",
        F.col("total_sales").cast("double").alias("forecast_sales"),
        F.col("total_sales").cast("double").alias("actual_sales"),
        "region",
    )
    sinks.append_forecasts(frame, path)
    sinks.append_forecasts(frame.withColumn("model", F.lit("mean")), path)
    read = files.read_parquet(star.spark, path, merge_schema=True)
    if "actual_sales" in read.columns:
        raise AssertionError("actual values were written")
    return read.groupBy("region").agg(
        F.count("*").alias("n"), F.count("model").alias("with_model"), F.sum("forecast_sales").alias("total")
    )


@query(
    "snk_forecast_csv",
    """WITH {fact} SELECT CAST(date AS VARCHAR) AS date, region, CAST(sum(sales) AS DOUBLE) AS forecast_sales
       FROM fact GROUP BY fact.date, region""",
)
def snk_forecast_csv(star):
    path = new_path(star.spark, "forecast-csv")
    frame = totals(star, ["date", "region"]).withColumn("forecast_sales", F.col("total_sales").cast("double"))
    frame = frame.drop("total_sales")
    sinks.write_forecast_csv(frame, path)
    return star.spark.read.schema(frame.schema).csv(path, header=True)


# --- projections and filters -----------------------------------------------------------------


@query(
    "prj_clean_fact",
    """WITH {fact} SELECT item, category, department, store, store_code, region, CAST(date AS VARCHAR) AS date,
       yearweek, sales, coalesce(event, '') AS event, round(CAST(coalesce(sell_price, 0) AS DOUBLE), 2) AS sell_price
       FROM fact""",
)
def prj_clean_fact(star):
    return rows.clean_fact(star.fact())


@query(
    "prj_model_rename",
    """WITH {fact} SELECT region, category, CAST(date AS VARCHAR) AS ds, CAST(sum(sales) AS DOUBLE) AS y,
       CAST(month(fact.date) = 12 AND day(fact.date) IN (23, 24, 26) AS INTEGER) AS is_christmas,
       CAST(month(fact.date) = 12 AND day(fact.date) = 25 AS INTEGER) AS is_holiday,
       CAST(isodow(fact.date) - 1 AS INTEGER) AS day_of_week,
       CAST(isodow(fact.date) >= 6 AS INTEGER) AS is_weekend
       FROM fact GROUP BY region, category, fact.date""",
)
def prj_model_rename(star):
    daily = totals(star, ["region", "category", "date"]).withColumnRenamed("total_sales", "sales")
    return rows.model_frame(dates.with_calendar_flags(daily, "date"), ["region", "category"])


@query(
    "prj_compact_types",
    """WITH {fact} SELECT item, CAST(sales AS INTEGER) AS sales, CAST(CAST(sell_price AS FLOAT) AS DOUBLE) AS sell_price
       FROM fact""",
)
def prj_compact_types(star):
    return rows.compact_types(star.fact("item", "sales", "sell_price"))


@query(
    "prj_null_counts",
    """WITH {fact} SELECT count(*) - count(item) AS item, count(*) - count(region) AS region,
       count(*) - count(event) AS event, count(*) - count(sales) AS sales FROM fact""",
)
def prj_null_counts(star):
    return aggregates.null_counts(star.fact("item", "region", "event", "sales"))


def _filtered(name: str, condition_sql: str, where=None, after=None):
    """Rows of the fact under a filter. ``where`` on base columns prunes the scan, ``after``
    uses joined attributes; both build their column when the query is run."""
    columns = ["item", "store_code", "region", "category", "department", "date", "yearweek", "event", "sales"]
    shown = ", ".join("CAST(date AS VARCHAR) AS date" if c == "date" else c for c in columns)

    @query(name, f"WITH {{fact}} SELECT {shown} FROM fact WHERE {condition_sql}")
    def build(star):
        df = star.fact(*columns, where=where() if where else None)
        return df.where(after()) if after else df


_filtered("flt_year", "year(fact.date) = 1998", lambda: files.year_range(1998))
_filtered(
    "flt_year_month",
    "year(fact.date) = 1998 AND month(fact.date) = 5",
    lambda: files.year_range(1998) & (F.month("date") == 5),
)
_filtered("flt_date_range", IN_YEAR_SQL.replace("date BETWEEN", "fact.date BETWEEN"), in_year)
_filtered(
    "flt_keys",
    f"region = '{REGION}' AND yearweek = {WEEK}",
    in_week,
    lambda: F.col("region") == REGION,
)
_filtered("flt_keys_category", f"category = '{CATEGORY}'", None, lambda: F.col("category") == CATEGORY)
_filtered(
    "flt_keys_department", f"department = '{DEPARTMENT}'", None, lambda: F.col("department") == DEPARTMENT
)
_filtered("flt_keys_item", f"item = '{ITEM}'", lambda: item_is(ITEM))
_filtered("flt_keys_store_code", f"store_code = '{STORE_CODE}'", lambda: store_code_is(STORE_CODE))
_filtered(
    "flt_series",
    f"item = '{ITEM}' AND store_code = '{STORE_CODE}'",
    lambda: item_is(ITEM) & store_code_is(STORE_CODE),
)
_filtered(
    "flt_yearweek_gt", "yearweek > 200001", lambda: F.col("date") > dates.week_dates(200001)[1]
)
_filtered("flt_event_present", HAS_EVENT_SQL, rows.event_present)


@query(
    "chk_required_columns",
    """WITH {fact} SELECT store, item, CAST(sum(sales) AS BIGINT) AS total_sales FROM fact GROUP BY 1, 2""",
)
def chk_required_columns(star):
    """The check happens while the plan is built; a missing column raises before any job."""
    daily = totals(star, ["store", "item", "date"])
    checked = schemas.require_columns(daily, {"store", "item", "date", "total_sales"})
    return checked.groupBy("store", "item").agg(F.sum("total_sales").alias("total_sales"))


@query(
    "flt_in_list",
    """WITH {fact}, top AS (SELECT item, sum(sales) AS t FROM fact GROUP BY item ORDER BY t DESC, item LIMIT 5)
       SELECT item, store_code, CAST(date AS VARCHAR) AS date, sales FROM fact WHERE item IN (SELECT item FROM top)""",
)
def flt_in_list(star):
    best = rows.top_k(totals(star, ["item"]), "total_sales", ["item"], 5)
    return rows.rows_of_items(star.fact("item", "store_code", "date", "sales"), best, "item")


@query(
    "flt_coerce_numeric",
    """SELECT event_type, event_id, try_cast(replace(props, '{"k": ', '') AS DOUBLE) AS bad,
       try_cast(regexp_extract(props, '[0-9]+') AS DOUBLE) AS k FROM events
       WHERE try_cast(regexp_extract(props, '[0-9]+') AS DOUBLE) IS NOT NULL""",
)
def flt_coerce_numeric(star):
    raw = star.table("events").select(
        "event_type",
        "event_id",
        scalars.coerce_double(F.replace(F.col("props"), F.lit('{"k": '), F.lit(""))).alias("bad"),
        F.regexp_extract("props", "[0-9]+", 0).alias("k"),
    )
    return rows.numeric_rows(raw, ["k"])


@query(
    "flt_quantile_cap",
    """WITH {fact}, m AS (SELECT store, item, CAST(sum(sales) AS DOUBLE) AS a, CAST(max(sell_price) AS DOUBLE) AS b
        FROM fact GROUP BY 1, 2)
       SELECT store, item, a, b FROM m WHERE a <= (SELECT quantile_cont(a, 0.95) FROM m)
         AND b <= (SELECT quantile_cont(b, 0.95) FROM m)""",
)
def flt_quantile_cap(star):
    measures = star.summarise(["store", "item"], a=("sum", "sales"), b=("max", "sell_price"))
    return rows.cap_by_quantile(materialise(measures, "measures"), ["a", "b"])


@query(
    "flt_date_coerce",
    """SELECT o_orderstatus, count(*) AS n, CAST(count(try_cast(
         CASE WHEN o_orderstatus = 'F' THEN 'not a date' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS DATE)) AS BIGINT)
         AS n_dates FROM orders GROUP BY 1""",
)
def flt_date_coerce(star):
    text = F.when(F.col("o_orderstatus") == "F", F.lit("not a date")).otherwise(
        F.col("o_orderdate").cast("date").cast("string")
    )
    orders = star.table("orders").select("o_orderstatus", scalars.coerce_date(text).alias("date"))
    return orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.count("date").alias("n_dates"))


# --- joins -----------------------------------------------------------------------------------


def _calendar(star):
    """One row per day with sales: label, date, week and event."""
    day = F.datediff(F.col("date"), F.lit("1995-01-01").cast("date"))
    return star.fact("date", "yearweek", "event").distinct().select(
        F.concat(F.lit("d_"), day).alias("d"), "date", "yearweek", "event"
    )


@query(
    "join_calendar",
    """WITH {fact} SELECT item, store_code, 'd_' || (date - DATE '1995-01-01') AS d, sales, yearweek,
       CAST(date AS VARCHAR) AS date, event FROM fact""",
)
def join_calendar(star):
    day = F.datediff(F.col("date"), F.lit("1995-01-01").cast("date"))
    sales = star.fact("item", "store_code", "date", "sales").select(
        "item", "store_code", F.concat(F.lit("d_"), day).alias("d"), "sales"
    )
    return joins.join_calendar(sales, _calendar(star))


PRICES_SQL = """prices AS (SELECT item, store_code, yearweek, max(category) AS category, max(sell_price)::DOUBLE AS sell_price
  FROM fact GROUP BY 1, 2, 3)"""


def _prices(star):
    """The price list: the highest price of an item in a store and week."""
    return star.summarise(
        ["item", "store_code", "yearweek", "category"],
        sell_price=("max", "sell_price"),
    ).withColumn("sell_price", F.col("sell_price").cast("double"))


@query(
    "join_prices",
    "WITH {fact}, " + PRICES_SQL + """ SELECT f.item, f.store_code, f.yearweek, f.sales, p.sell_price,
       p.category AS category_price FROM fact f LEFT JOIN prices p
       ON f.item = p.item AND f.store_code = p.store_code AND f.yearweek = p.yearweek""",
)
def join_prices(star):
    sales = star.fact("item", "store_code", "yearweek", "sales")
    return joins.join_prices(sales, _prices(star))


@query(
    "join_price_sales",
    """WITH {fact}, a AS (SELECT date, item, sum(sales)::BIGINT AS sales FROM fact GROUP BY 1, 2),
       b AS (SELECT date, item, CAST(sum(sell_price) AS DOUBLE) / count(sell_price) AS sell_price FROM fact GROUP BY 1, 2)
       SELECT CAST(a.date AS VARCHAR) AS date, a.item, sales, sell_price
       FROM a JOIN b ON a.date = b.date AND a.item = b.item""",
)
def join_price_sales(star):
    return joins.price_and_sales(star.fact("date", "item", "sales", "sell_price"))


@query(
    "join_monthly_exog",
    """WITH {fact}, d AS (SELECT date, sum(sales) AS sales FROM fact GROUP BY 1),
       s AS (SELECT last_day(date) AS date, sum(sales)::BIGINT AS sales FROM d GROUP BY 1),
       x AS (SELECT last_day(date) AS date, sum(CAST(month(date) = 12 AND day(date) IN (23, 24, 26) AS INTEGER))::BIGINT AS is_christmas,
         sum(CAST(isodow(date) >= 6 AS INTEGER))::BIGINT AS is_weekend FROM d GROUP BY 1)
       SELECT CAST(s.date AS VARCHAR) AS date, sales, is_christmas, is_weekend FROM s LEFT JOIN x USING (date)""",
)
def join_monthly_exog(star):
    daily = totals(star, ["date"]).withColumnRenamed("total_sales", "sales")
    monthly = daily.groupBy(F.last_day("date").alias("date")).agg(F.sum("sales").alias("sales"))
    flagged = dates.with_calendar_flags(daily.select("date"), "date")
    flags = flagged.groupBy(F.last_day("date").alias("date")).agg(
        F.sum("is_christmas").alias("is_christmas"), F.sum("is_weekend").alias("is_weekend")
    )
    return joins.monthly_with_regressors(monthly, flags)


@query(
    "join_future_regressors",
    """WITH {fact}, last AS (SELECT region, max(date) AS m FROM fact GROUP BY 1),
       future AS (SELECT region, unnest(generate_series(m + INTERVAL 1 DAY, m + INTERVAL 28 DAY, INTERVAL 1 DAY))::DATE AS ds FROM last),
       known AS (SELECT DISTINCT (date + INTERVAL 364 DAY)::DATE AS ds, 1 AS had_sales FROM fact)
       SELECT region, CAST(f.ds AS VARCHAR) AS ds, coalesce(had_sales, 0) AS had_sales
       FROM future f LEFT JOIN known k ON f.ds = k.ds""",
)
def join_future_regressors(star):
    last = star.summarise(["region"], last=("max", "date"))
    days = F.sequence(F.date_add("last", 1), F.date_add("last", 28))
    future = last.select("region", F.explode(days).alias("ds"))
    known = star.summarise(["date"], n=("count", "sales")).select(
        F.date_add("date", 364).alias("ds"), F.lit(1).alias("had_sales")
    )
    return joins.with_future_regressors(future, known, ["had_sales"], ["ds"])


@query(
    "join_semi_top_labels",
    """WITH {fact}, top AS (SELECT sales, count(*) AS n FROM fact GROUP BY 1 ORDER BY n DESC, sales LIMIT 10)
       SELECT store_code, sales, count(*) AS n FROM fact WHERE sales IN (SELECT sales FROM top) GROUP BY 1, 2""",
)
def join_semi_top_labels(star):
    lines = star.fact("store_code", "sales")
    labels = aggregates.value_counts(lines, "sales", 10)
    kept = rows.rows_of_items(lines, labels, "sales")
    return kept.groupBy("store_code", "sales").agg(F.count("*").alias("n"))


@query(
    "join_event_dates",
    """WITH {fact}, e AS (SELECT DISTINCT date FROM fact WHERE event IS NOT NULL),
       d AS (SELECT region, date, sum(sales)::BIGINT AS total_sales FROM fact GROUP BY 1, 2)
       SELECT region, CAST(date AS VARCHAR) AS date, total_sales,
       CAST(date IN (SELECT date FROM e) AS INTEGER) AS is_event FROM d""",
)
def join_event_dates(star):
    event_days = star.summarise(["date", "event"], n=("count", "sales")).where(rows.event_present())
    return joins.flag_event_dates(totals(star, ["region", "date"]), event_days)


EVENT_LIST_SQL = """ev AS (SELECT DISTINCT date AS ds, event,
    CASE WHEN event IN ('NewYear', 'Thanksgiving') THEN -1 ELSE 0 END AS lo,
    CASE WHEN event IN ('SuperBowl', 'Ramadan starts', 'Easter', 'NewYear', 'Thanksgiving') THEN 1 ELSE 0 END AS hi
    FROM fact WHERE event IS NOT NULL AND event <> ''),
  x AS (SELECT event, (ds + INTERVAL (k) DAY)::DATE AS ds, k AS offs FROM ev, (SELECT unnest([-1, 0, 1])::INTEGER AS k)
    WHERE k BETWEEN lo AND hi)"""


def event_list(star):
    """The distinct events of the fact with their windows."""
    events = star.summarise(["date", "event"], n=("count", "sales")).where(rows.event_present())
    lower, upper = dates.event_window(F.col("event"))
    return events.select(
        "event", F.col("date").alias("ds"), lower.alias("lower_window"), upper.alias("upper_window")
    )


@query(
    "join_events_window",
    "WITH {fact}, " + EVENT_LIST_SQL + """, d AS (SELECT region, date AS ds, sum(sales)::BIGINT AS y FROM fact GROUP BY 1, 2)
       SELECT region, CAST(d.ds AS VARCHAR) AS ds, y, event, coalesce(offs, 0) AS "offset" FROM d LEFT JOIN x ON d.ds = x.ds""",
)
def join_events_window(star):
    daily = totals(star, ["region", "date"]).select("region", F.col("date").alias("ds"), F.col("total_sales").alias("y"))
    return joins.join_events(daily, event_list(star)).fillna(0, ["offset"])


@query(
    "join_reindex_fill",
    """WITH {fact}, e AS (SELECT region, date AS ds, max(CASE WHEN event IS NOT NULL THEN 1 ELSE 0 END) AS has_event FROM fact GROUP BY 1, 2),
       sp AS (SELECT region, unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY))::DATE AS ds FROM e GROUP BY 1)
       SELECT sp.region, CAST(sp.ds AS VARCHAR) AS ds, coalesce(has_event, 0) AS has_event
       FROM sp LEFT JOIN e ON sp.region = e.region AND sp.ds = e.ds""",
)
def join_reindex_fill(star):
    days = star.summarise(["region", "date", "event"], n=("count", "sales"))
    flags = days.groupBy("region", F.col("date").alias("ds")).agg(
        F.max(F.col("event").isNotNull().cast("int")).alias("has_event")
    )
    return series.densify(flags, ["region"], "ds", {"has_event": F.lit(0)}).select("region", "ds", "has_event")


# --- set operations --------------------------------------------------------------------------


@query(
    "set_union_all",
    """WITH {fact} SELECT region, CAST(year(date) AS INTEGER) AS year, count(*) AS n, count(CASE WHEN year(date) = 1997 THEN 1 END) AS marked
       FROM fact WHERE year(date) BETWEEN 1996 AND 1998 GROUP BY 1, 2""",
)
def set_union_all(star):
    slices = [star.fact("region", "date", where=files.year_range(y)) for y in (1996, 1997, 1998)]
    slices[1] = slices[1].withColumn("mark", F.lit(1))
    return files.union_all(slices).groupBy("region", F.year("date").alias("year")).agg(
        F.count("*").alias("n"), F.count("mark").alias("marked")
    )


@query("set_distinct_rows", "WITH {fact} SELECT DISTINCT store, category FROM fact")
def set_distinct_rows(star):
    return star.summarise(["store", "category"], n=("count", "sales")).select("store", "category")


@query(
    "set_distinct_event_dates",
    "WITH {fact} SELECT DISTINCT CAST(date AS VARCHAR) AS date FROM fact WHERE event IS NOT NULL",
)
def set_distinct_event_dates(star):
    return star.fact("date", "event").where(F.col("event").isNotNull()).select("date").distinct()


@query(
    "set_missing_dates",
    """WITH {fact}, d AS (SELECT DISTINCT region, category, date FROM fact),
       sp AS (SELECT region, category, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY))::DATE AS date FROM d GROUP BY 1, 2)
       SELECT region, category, CAST(date AS VARCHAR) AS date FROM (SELECT * FROM sp EXCEPT SELECT * FROM d)""",
)
def set_missing_dates(star):
    present = star.summarise(["region", "category", "date"], n=("count", "sales"))
    return series.missing_dates(present, ["region", "category"], "date")


# --- reshaping -------------------------------------------------------------------------------


@query("rsh_melt_days", WIDE_SQL + " SELECT region, category, period, d, sales FROM long")
def rsh_melt_days(star):
    wide = _wide_sales(star)
    return reshape.melt_days(wide, ["region", "category", "period"]).where(F.col("sales").isNotNull())


@query(
    "rsh_melt_series",
    "WITH {fact}, s AS (SELECT unnest(["
    + ", ".join(f"'{r}'" for r in [*REGIONS, reshape.OTHER])
    + """]) AS "ID"), d AS (SELECT DISTINCT date FROM fact),
       t AS (SELECT date, region, sum(sales)::BIGINT AS y FROM fact GROUP BY 1, 2)
       SELECT CAST(d.date AS VARCHAR) AS ds, coalesce(y, 0)::BIGINT AS y, "ID" FROM d CROSS JOIN s
       LEFT JOIN t ON t.date = d.date AND t.region = s."ID" """,
)
def rsh_melt_series(star):
    wide = reshape.pivot_sum(totals(star, ["date", "region"]), ["date"], "region", "total_sales", REGIONS)
    return reshape.melt_series(wide, "date", [*REGIONS, reshape.OTHER])


@query(
    "rsh_onehot_event",
    """WITH {fact} SELECT CAST(date AS VARCHAR) AS date, CAST(sum(sales) AS BIGINT) AS total_sales,
       CAST(coalesce(event = 'Christmas', false) AS INTEGER) AS "event_Christmas",
       CAST(coalesce(event = 'Halloween', false) AS INTEGER) AS "event_Halloween",
       CAST(coalesce(event = 'Independence', false) AS INTEGER) AS "event_Independence",
       CAST(coalesce(event = 'NewYear', false) AS INTEGER) AS "event_NewYear",
       CAST(coalesce(event = 'Valentine', false) AS INTEGER) AS "event_Valentine",
       CAST(coalesce(event NOT IN ('Christmas', 'Halloween', 'Independence', 'NewYear', 'Valentine'), false)
         AS INTEGER) AS event_other,
       CAST(event IS NULL AS INTEGER) AS event_nan
       FROM fact GROUP BY fact.date, event""",
)
def rsh_onehot_event(star):
    daily = totals(star, ["date", "event"])
    return reshape.one_hot(daily, "event", sorted(CALENDAR_EVENTS.values()), null_column=True)


@query(
    "win_duplicates",
    """WITH {fact} SELECT item, store_code, yearweek, count(*) - 1 AS duplicates FROM fact
       GROUP BY 1, 2, 3 HAVING count(*) > 1""",
)
def win_duplicates(star):
    return windows.duplicate_counts(star.fact("item", "store_code", "yearweek"), ["item", "store_code", "yearweek"])


@query(
    "win_ffill",
    """WITH {fact}, w AS (SELECT store, yearweek, sum(sales)::BIGINT AS s, CASE WHEN sum(sales) > 60 THEN sum(sales) END::BIGINT AS v
         FROM fact GROUP BY 1, 2)
       SELECT store, yearweek, s, coalesce(last_value(v IGNORE NULLS) OVER
         (PARTITION BY store ORDER BY yearweek ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1) AS v FROM w""",
)
def win_ffill(star):
    weekly = totals(star, ["store", "yearweek"]).select(
        "store", "yearweek", F.col("total_sales").alias("s"),
        F.when(F.col("total_sales") > 60, F.col("total_sales")).alias("v"),
    )
    return windows.forward_fill(weekly, ["store"], ["yearweek"], "v").fillna(-1, ["v"])


@query(
    "win_monotone_week",
    """WITH RECURSIVE {fact}, p AS (SELECT store_code, category, (yearweek // 100 * 100 + 1)::INTEGER AS yearweek,
         row_number() OVER (PARTITION BY store_code, category ORDER BY yearweek) AS rn
         FROM (SELECT DISTINCT store_code, category, yearweek FROM fact)),
       r AS (SELECT store_code, category, rn, yearweek AS w FROM p WHERE rn = 1
         UNION ALL SELECT p.store_code, p.category, p.rn, greatest(p.yearweek, r.w + 1) FROM p JOIN r
           ON p.store_code = r.store_code AND p.category = r.category AND p.rn = r.rn + 1)
       SELECT store_code, category, w AS yearweek FROM r""",
)
def win_monotone_week(star):
    """Weeks cut down to the first of their year, so that they repeat and must be raised."""
    weeks = star.summarise(["store_code", "category", "yearweek"], n=("count", "sales"))
    first = (F.floor(F.col("yearweek") / 100) * 100 + 1).cast("int")
    cut = weeks.select("store_code", "category", first.alias("yearweek"))
    return windows.monotone_weeks(cut, ["store_code", "category"])


# --- scalar functions ------------------------------------------------------------------------


def _order_dates(star):
    return star.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))


@query(
    "fn_iso_yearweek",
    """SELECT o_orderkey, CAST(isoyear(o_orderdate) * 100 + week(o_orderdate) AS INTEGER) AS yearweek FROM orders""",
)
def fn_iso_yearweek(star):
    return _order_dates(star).select("o_orderkey", dates.iso_yearweek(F.col("date")).alias("yearweek"))


@query(
    "fn_day_of_week",
    "SELECT o_orderkey, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS day_of_week FROM orders",
)
def fn_day_of_week(star):
    return _order_dates(star).select("o_orderkey", dates.day_of_week(F.col("date")).alias("day_of_week"))


@query("fn_day_name", "SELECT o_orderkey, dayname(o_orderdate) AS day_name FROM orders")
def fn_day_name(star):
    return _order_dates(star).select("o_orderkey", dates.day_name(F.col("date")).alias("day_name"))


@query(
    "fn_year_month",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
       FROM orders""",
)
def fn_year_month(star):
    return _order_dates(star).select("o_orderkey", F.year("date").alias("year"), F.month("date").alias("month"))


@query(
    "fn_calendar_flags",
    """SELECT o_orderkey, CAST(month(o_orderdate) = 12 AND day(o_orderdate) IN (23, 24, 26) AS INTEGER) AS is_christmas,
       CAST(month(o_orderdate) = 12 AND day(o_orderdate) = 25 AS INTEGER) AS is_holiday,
       CAST(isodow(o_orderdate) - 1 AS INTEGER) AS day_of_week,
       CAST(isodow(o_orderdate) >= 6 AS INTEGER) AS is_weekend FROM orders""",
)
def fn_calendar_flags(star):
    return dates.with_calendar_flags(_order_dates(star), "date").drop("date")


@query(
    "fn_assign_events",
    """WITH {fact} SELECT CAST(date AS VARCHAR) AS date,
       CASE WHEN month(fact.date) = 12 AND day(fact.date) = 23 THEN 'Natal D-2' WHEN month(fact.date) = 12 AND day(fact.date) = 24 THEN 'Natal D-1'
         WHEN month(fact.date) = 12 AND day(fact.date) = 26 THEN 'Boxing Day' ELSE event END AS december_event,
       CASE WHEN month(fact.date) = 12 AND day(fact.date) = 25 AND year(fact.date) BETWEEN 1995 AND 2000 THEN 'Natal' ELSE event END AS natal_event,
       CAST(sum(sales) AS BIGINT) AS total_sales FROM fact GROUP BY fact.date, event""",
)
def fn_assign_events(star):
    date, event = F.col("date"), F.col("event")
    return totals(star, ["date", "event"]).select(
        "date",
        dates.december_events(date, event).alias("december_event"),
        dates.natal_events(date, event, range(1995, 2001)).alias("natal_event"),
        "total_sales",
    )


@query(
    "fn_event_window",
    "WITH {fact}, " + EVENT_LIST_SQL + " SELECT event, CAST(ds AS VARCHAR) AS ds, lo AS lower_window, hi AS upper_window FROM ev",
)
def fn_event_window(star):
    return event_list(star)


def _condition_sql() -> str:
    parts = []
    for season, months in dates.SEASON_MONTHS.items():
        inside = f"month(o_orderdate) IN {months}"
        parts.append(f"CAST({inside} AS INTEGER) AS {season}")
        parts.append(f"CAST({inside} AND isodow(o_orderdate) < 6 AS INTEGER) AS {season}_weekday")
        parts.append(f"CAST({inside} AND isodow(o_orderdate) >= 6 AS INTEGER) AS {season}_weekend")
    on = "month(o_orderdate) IN (9, 10, 11, 12, 1)"
    parts += [f"CAST({on} AS INTEGER) AS on_season", f"CAST(NOT {on} AS INTEGER) AS off_season"]
    parts += [f"CAST(quarter(o_orderdate) = {q} AS INTEGER) AS quarter_{q}" for q in range(1, 5)]
    return "SELECT o_orderkey, " + ", ".join(parts) + " FROM orders"


@query("fn_condition_columns", _condition_sql())
def fn_condition_columns(star):
    df = _order_dates(star)
    return df.withColumns(dates.condition_columns(F.col("date"))).drop("date")


@query(
    "fn_log1p",
    """WITH {fact}, d AS (SELECT region, date, sum(sales)::BIGINT AS y FROM fact GROUP BY 1, 2)
       SELECT region, CAST(date AS VARCHAR) AS date, round(ln(1 + y), 6) AS log_sales, CAST(round(exp(ln(1 + y)) - 1) AS BIGINT) AS back FROM d""",
)
def fn_log1p(star):
    log = F.log1p(F.col("total_sales"))
    df = totals(star, ["region", "date"]).select(
        "region", "date", log.alias("log_sales"), F.round(F.expm1(log)).cast("bigint").alias("back")
    )
    return rounded(df, "log_sales")


@query(
    "fn_clamp_nonneg",
    "SELECT c_custkey, greatest(0.0::DOUBLE, c_acctbal) AS balance FROM customer",
)
def fn_clamp_nonneg(star):
    return star.table("customer").select(
        "c_custkey", scalars.clamp_non_negative(F.col("c_acctbal")).alias("balance")
    )


@query(
    "fn_null_fill",
    """WITH {fact}, t AS (SELECT store, CASE WHEN sum(sales) % 3 <> 0 THEN sum(sales) END::DOUBLE AS x FROM fact GROUP BY 1)
       SELECT store, coalesce(x, 0) AS zero_filled, round(coalesce(x, (SELECT avg(x) FROM t)), 6) AS mean_filled FROM t""",
)
def fn_null_fill(star):
    known = F.when(F.col("total_sales") % 3 != 0, F.col("total_sales")).cast("double")
    gaps = totals(star, ["store"]).select("store", known.alias("zero_filled"), known.alias("mean_filled"))
    filled = rows.fill_with_mean(gaps.fillna(0, ["zero_filled"]), ["mean_filled"])
    return rounded(filled, "mean_filled")


@query(
    "fn_unit_convert",
    "SELECT event_id, round((value - 273.15::DOUBLE) * 1.8::DOUBLE + 32, 6) + 0.0 AS fahrenheit FROM events",
)
def fn_unit_convert(star):
    df = star.table("events").select(
        "event_id", scalars.kelvin_to_fahrenheit(F.col("value")).alias("fahrenheit")
    )
    return rounded(df, "fahrenheit")


@query("fn_name_normalise", "SELECT p_partkey, replace(p_name, ' ', '_') AS name FROM part")
def fn_name_normalise(star):
    return star.table("part").select("p_partkey", scalars.normalise_name(F.col("p_name")).alias("name"))
