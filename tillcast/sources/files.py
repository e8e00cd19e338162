"""Readers: CSV, Parquet, SQL text, JDBC options, schema listing."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast import schemas
from tillcast.functions.dates import iso_yearweek

log = logging.getLogger(__name__)


def day_columns(df: DataFrame, prefix: str = "d_") -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def read_sales_wide(spark: SparkSession, path: str, n_days: int | None = None) -> DataFrame:
    """Wide sales CSV. With ``n_days`` the schema is fixed; otherwise only the header is read
    to learn the day columns, never the data."""
    if n_days is None:
        header = spark.read.csv(path, header=True).columns
        n_days = sum(c.startswith("d_") for c in header)
    return spark.read.schema(schemas.sales_wide_schema(n_days)).csv(path, header=True)


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """Calendar CSV with parsed dates and the derived ISO ``yearweek``."""
    df = spark.read.schema(schemas.CALENDAR).csv(path, header=True, dateFormat="yyyy-MM-dd")
    return df.withColumn("yearweek", iso_yearweek(F.col("date")))


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PRICES).csv(path, header=True)


def read_csv_lenient(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV reader that skips malformed lines."""
    return spark.read.schema(schema).csv(path, header=True, mode="DROPMALFORMED")


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """A directory of part files as one table."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def query_table(spark: SparkSession, sql: str, views: dict[str, DataFrame]) -> DataFrame:
    """Run SQL text over the given views; logs the column count, stays lazy."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    result = spark.sql(sql)
    log.info("query returns %d columns", len(result.columns))
    return result


def jdbc_options(
    url: str,
    table: str,
    column: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 1,
    fetch_size: int = 50_000,
) -> dict[str, str]:
    """Options of a partitioned JDBC read: a range of ``column`` per task, rows in chunks."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if column is not None:
        if bounds is None:
            raise ValueError("a partition column needs bounds")
        options |= {
            "partitionColumn": column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def describe_schema(df: DataFrame) -> DataFrame:
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema]
    return df.sparkSession.createDataFrame(rows, "name string, type string")


def sample_rows(df: DataFrame, order_by: list, n: int = 10) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order_by).limit(n)


def year_range(first: int, last: int | None = None, date: str = "date"):
    """Date range of whole years, written so that file statistics can prune."""
    last = first if last is None else last
    lower = F.lit(f"{first}-01-01").cast("date")
    upper = F.lit(f"{last + 1}-01-01").cast("date")
    return (F.col(date) >= lower) & (F.col(date) < upper)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Concatenate frames by column name; a column missing in one becomes NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
