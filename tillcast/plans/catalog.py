"""Registry of named queries: each runs over the star tables and may carry checking SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.sources.star import CALENDAR_EVENTS, SalesStar

_EVENT_CASES = " ".join(
    f"WHEN month(l_shipdate) = {m} AND day(l_shipdate) = {d} THEN '{name}'"
    for (m, d), name in CALENDAR_EVENTS.items()
)

# The fact as SQL over the same tables; ``{fact}`` in a checking query stands for this.
FACT_CTE = f"""fact AS (
  SELECT CAST(l_partkey AS VARCHAR) AS item, p_type AS category, p_type AS category_price,
         p_brand AS department, s_name AS store, CAST(l_suppkey AS VARCHAR) AS store_code,
         r_name AS region, CAST(l_shipdate AS DATE) AS date,
         CAST(isoyear(l_shipdate) * 100 + week(l_shipdate) AS INTEGER) AS yearweek,
         CAST(l_quantity AS BIGINT) AS sales,
         CAST(((2 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS BIGINT))
           // (2 * CAST(l_quantity AS BIGINT))) / 100.0::DOUBLE AS DECIMAL(10, 2)) AS sell_price,
         CASE {_EVENT_CASES} END AS event
  FROM lineitem
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
)"""


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SalesStar], DataFrame]
    sql: str | None


_registry: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(star)`` under ``name``. Without SQL only rows and schema are checked."""

    def register(build: Callable[[SalesStar], DataFrame]):
        if name in _registry:
            raise ValueError(f"query {name} is registered twice")
        text = sql.replace("{fact}", FACT_CTE).strip() if sql else None
        _registry[name] = Query(name, build, text)
        return build

    return register


def registered() -> dict[str, Query]:
    # Importing the modules registers their queries.
    from tillcast.plans import model_queries, retail_queries, series_queries, table_queries  # noqa: F401

    return dict(_registry)


def run(name: str, spark: SparkSession, root: str) -> DataFrame:
    return presentable(registered()[name].build(SalesStar(spark, root)))


def presentable(df: DataFrame) -> DataFrame:
    """Types every client reads alike: dates and times as text, decimals and floats as double."""
    columns = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string").alias(f.name)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double").alias(f.name)
        columns.append(c)
    return df.select(*columns)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})
