"""Row filters, projections and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions.dates import FLAG_COLUMNS
from tillcast.functions.scalars import coerce_double
from tillcast.operators.quantiles import exact_quantiles


def clean_fact(df: DataFrame) -> DataFrame:
    """One ``category``, no ``d``; missing events become '', missing prices 0, two decimals."""
    df = df.withColumnRenamed("category_x", "category").drop("category_y", "category_price", "d")
    if "event" in df.columns:
        df = df.withColumn("event", F.coalesce("event", F.lit("")))
    price = F.round(F.coalesce(F.col("sell_price").cast("double"), F.lit(0.0)), 2)
    return df.withColumn("sell_price", price)


def model_frame(df: DataFrame, keys: list[str], regressors: list[str] | None = None) -> DataFrame:
    regressors = FLAG_COLUMNS if regressors is None else regressors
    return df.select(
        *keys, F.col("date").alias("ds"), F.col("sales").cast("double").alias("y"), *regressors
    )


def compact_types(df: DataFrame) -> DataFrame:
    return df.withColumns({"sales": F.col("sales").cast("int"), "sell_price": F.col("sell_price").cast("float")})


def event_present(event: str = "event") -> Column:
    return F.col(event).isNotNull() & (F.col(event) != "")


def numeric_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cast to numbers, drop rows in which one of them is missing or malformed."""
    return df.withColumns({c: coerce_double(F.col(c)) for c in columns}).dropna(subset=columns)


def cap_by_quantile(df: DataFrame, columns: list[str], q: float = 0.95) -> DataFrame:
    """Rows whose values are all at or below the column's ``q`` quantile over the whole table."""
    entries = [F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_x")) for c in columns]
    long = df.select(F.inline(F.array(*entries)))
    limits = exact_quantiles(long, ["_c"], "_x", {"_limit": q})
    packed = [F.max(F.when(F.col("_c") == c, F.col("_limit"))).alias(c) for c in columns]
    limit = limits.agg(F.struct(*packed)).scalar()
    kept = df.withColumns({c: F.col(c).cast("double") for c in columns})
    for c in columns:
        kept = kept.where(F.col(c) <= limit[c])
    return kept


def rows_of_items(df: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a short computed list."""
    return df.join(chosen.select(key), key, "left_semi")


def top_k(df: DataFrame, measure: str, tie: list[str], k: int) -> DataFrame:
    """The ``k`` largest rows; each task keeps ``k`` rows before they are merged."""
    return df.orderBy(F.desc(measure), *[F.asc_nulls_first(c) for c in tie]).limit(k)


def bottom_k(df: DataFrame, measure: str, tie: list[str], k: int) -> DataFrame:
    return df.orderBy(F.asc(measure), *[F.asc_nulls_first(c) for c in tie]).limit(k)


def fill_with_mean(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL to the column mean over the whole table."""
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in columns])).scalar()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), means[c]) for c in columns})
