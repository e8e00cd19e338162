"""The sales fact over a star of line items, parts, suppliers, nations and regions.

The fact is a chain of LEFT joins from the line items to dimensions with unique keys, so a
dimension that no requested column needs can be left out without changing any row. That lets
:meth:`SalesStar.fact` join only what a query reads, and lets :meth:`SalesStar.summarise`
aggregate the line items by their foreign keys before a dimension is joined.

Part and supplier grow with the data. Their rows are counted once per process (a scan without
columns, answered from the file footers). Below :data:`BROADCAST_ROWS` a dimension is broadcast
and the fact is grouped right after the join. Above it the line items are grouped by foreign key
first, and the grouped rows meet the dimension in a sort-merge join, whose hot keys AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.functions.dates import iso_yearweek

# Events of the calendar by (month, day).
CALENDAR_EVENTS = {
    (12, 25): "Christmas",
    (1, 1): "NewYear",
    (7, 4): "Independence",
    (10, 31): "Halloween",
    (2, 14): "Valentine",
}

# The categories, regions and months that wide reports have columns for.
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
PERIODS = [f"{year}_{month:02d}" for year in range(1995, 2002) for month in range(1, 13)]

PART_COLUMNS = {"category": "p_type", "category_price": "p_type", "department": "p_brand"}
STORE_COLUMNS = {"store": "s_name"}
REGION_COLUMNS = {"region": "r_name"}
BASE_COLUMNS = [
    "item", "store_code", "date", "yearweek", "sales", "sell_price", "event",
]
FACT_COLUMNS = [*BASE_COLUMNS, *PART_COLUMNS, *STORE_COLUMNS, *REGION_COLUMNS]


_schemas: dict[str, T.StructType] = {}


def calendar_event(date: Column) -> Column:
    named = F.lit(None).cast("string")
    for (month, day), name in CALENDAR_EVENTS.items():
        named = F.when((F.month(date) == month) & (F.dayofmonth(date) == day), name).otherwise(named)
    return named


def unit_price() -> Column:
    """Price per unit in whole cents, halves up, in integer arithmetic: no rounding of doubles."""
    line, units = "cast(round(l_extendedprice * 100) as bigint)", "cast(l_quantity as bigint)"
    cents = F.expr(f"(2 * {line} + {units}) div nullif(2 * {units}, 0)")
    return (cents / 100).cast("decimal(10,2)")


def item_is(item: str) -> Column:
    """``item = ...`` on the stored key, so that the filter reaches the scan."""
    return F.col("_part") == F.lit(int(item))


def store_code_is(store_code: str) -> Column:
    return F.col("_supp") == F.lit(int(store_code))


# Largest dimension that is broadcast; at under 100 bytes a row this stays below 25 MB.
BROADCAST_ROWS = 250_000



class SalesStar:
    def __init__(self, spark: SparkSession, root: str, broadcast_rows: int = BROADCAST_ROWS):
        self.spark = spark
        self.root = root
        self.broadcast_rows = broadcast_rows
        self._row_counts: dict[str, int] = {}

    def _is_small(self, name: str) -> bool:
        if name not in self._row_counts:
            self._row_counts[name] = self.table(name).count()
        return self._row_counts[name] <= self.broadcast_rows

    def table(self, name: str) -> DataFrame:
        """A table of the star; its schema is read from the files once per process."""
        path = f"{self.root}/{name}.parquet"
        if path not in _schemas:
            _schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[path]).parquet(path)

    def _lines(self) -> DataFrame:
        date = F.col("l_shipdate").cast("date")
        return self.table("lineitem").select(
            F.col("l_partkey").alias("_part"),
            F.col("l_suppkey").alias("_supp"),
            F.col("l_partkey").cast("string").alias("item"),
            F.col("l_suppkey").cast("string").alias("store_code"),
            date.alias("date"),
            iso_yearweek(date).alias("yearweek"),
            F.col("l_quantity").cast("bigint").alias("sales"),
            unit_price().alias("sell_price"),
            calendar_event(date).alias("event"),
        )

    def items(self, *columns: str) -> DataFrame:
        """Item dimension: ``_part`` plus the requested item attributes."""
        return self.table("part").select(
            F.col("p_partkey").alias("_part"), *[F.col(PART_COLUMNS[c]).alias(c) for c in columns]
        )

    def stores(self, *columns: str) -> DataFrame:
        """Store dimension: ``_supp`` plus the requested store attributes."""
        stores = self.table("supplier")
        if "region" in columns:
            nations = self.table("nation").select("n_nationkey", "n_regionkey")
            regions = self.table("region").select("r_regionkey", F.col("r_name").alias("region"))
            stores = stores.join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left")
            stores = stores.join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        picked = [F.col(STORE_COLUMNS[c]).alias(c) if c in STORE_COLUMNS else F.col(c) for c in columns]
        return stores.select(F.col("s_suppkey").alias("_supp"), *picked)

    def _join_items(self, df: DataFrame, columns: list[str]) -> DataFrame:
        if not columns:
            return df
        items = self.items(*columns)
        return df.join(F.broadcast(items) if self._is_small("part") else items, "_part", "left")

    def _join_stores(self, df: DataFrame, columns: list[str]) -> DataFrame:
        if not columns:
            return df
        stores = self.stores(*columns)
        return df.join(F.broadcast(stores) if self._is_small("supplier") else stores, "_supp", "left")

    @staticmethod
    def _split(columns) -> tuple[list[str], list[str], list[str]]:
        unknown = set(columns) - set(FACT_COLUMNS)
        if unknown:
            raise ValueError(f"unknown fact columns: {sorted(unknown)}")
        base = [c for c in columns if c in BASE_COLUMNS]
        item = [c for c in columns if c in PART_COLUMNS]
        store = [c for c in columns if c in STORE_COLUMNS or c in REGION_COLUMNS]
        return base, item, store

    def fact(self, *columns: str, where: Column | None = None) -> DataFrame:
        """Row-level fact with the requested columns (all of them when none is named).

        ``where`` may use base columns (and the filters above); it is applied before any join.
        """
        columns = columns or tuple(FACT_COLUMNS)
        _, item, store = self._split(columns)
        df = self._lines()
        if where is not None:
            df = df.where(where)
        df = self._join_items(df, item)
        df = self._join_stores(df, store)
        return df.select(*columns)

    def summarise(
        self,
        by: list[str],
        where: Column | None = None,
        item_where: Column | None = None,
        store_where: Column | None = None,
        **measures: tuple[str, str | tuple[str, str]],
    ) -> DataFrame:
        """Group the fact by ``by`` with measures such as ``total=("sum", "sales")``.

        Supported functions are ``sum, count, avg, min, max``, ``std`` (of the sample) and
        ``corr`` of two columns. All are made of sums that merge, so they can be taken in two
        steps. ``item_where`` and ``store_where`` are conditions on item and store attributes;
        rows of other items and stores are dropped before they are grouped.

        Small dimensions are broadcast first. Before a large one is joined, the rows are grouped
        by its foreign key: map-side combine makes a hot key one row per task, and the raw rows
        are not shuffled for a join. With two large dimensions, or single stores beside a large
        item dimension, the items are joined first and the grouping happens on ``(store key, item
        attributes)``.
        """
        _, item, store = self._split(by)
        df = self._lines()
        if where is not None:
            df = df.where(where)
        if item_where is not None:
            wanted = self.items(*PART_COLUMNS).where(item_where).select("_part")
            df = self._semi(df, wanted, "_part", "part")
        if store_where is not None:
            wanted = self.stores(*STORE_COLUMNS, *REGION_COLUMNS).where(store_where).select("_supp")
            df = self._semi(df, wanted, "_supp", "supplier")
        large_item = bool(item) and not self._is_small("part")
        large_store = bool(store) and not self._is_small("supplier")
        # By item and single store hardly two lines meet, so that grouping them saves nothing and
        # only fills memory: the items are joined first, and stores are grouped by their short key.
        large_store = large_store or (large_item and "store" in store)
        if not large_item:
            df = self._join_items(df, item)
        if not large_store:
            df = self._join_stores(df, store)
        parts = _partials(measures)
        finals = [_final(n, f, c) for n, (f, c) in measures.items()]
        if not (large_item or large_store):
            return df.groupBy(*by).agg(*[p.first() for p in parts]).select(*by, *finals)
        if large_item and large_store:
            df = self._join_items(df, item)
        key = "_supp" if large_store else "_part"
        later = store if large_store else item
        df = df.groupBy(key, *[c for c in by if c not in later]).agg(*[p.first() for p in parts])
        df = self._join_stores(df, store) if large_store else self._join_items(df, item)
        return df.groupBy(*by).agg(*[p.merge() for p in parts]).select(*by, *finals)

    def _semi(self, df: DataFrame, wanted: DataFrame, key: str, table: str) -> DataFrame:
        return df.join(F.broadcast(wanted) if self._is_small(table) else wanted, key, "left_semi")


class _Partial:
    """One partial aggregate of fact columns, and how partial results merge.

    ``square`` and ``product`` are exact sums of products. With ``both`` only rows in which that
    column isn't NULL either are taken.
    """

    def __init__(self, function: str, column: str, both: str | None = None):
        self.function, self.column, self.both = function, column, both
        self.name = f"_{function}_{column}" + (f"_{both}" if both else "")

    def first(self) -> Column:
        value = F.col(self.column)
        if self.function in ("square", "product"):
            other = F.col(self.column if self.function == "square" else self.both)
            value = (value * other).cast("decimal(38,4)")
        if self.both:
            value = F.when(F.col(self.both).isNotNull(), value)
        functions = {"count": F.count, "min": F.min, "max": F.max}
        return functions.get(self.function, F.sum)(value).alias(self.name)

    def merge(self) -> Column:
        functions = {"min": F.min, "max": F.max}
        return functions.get(self.function, F.sum)(self.name).alias(self.name)


def _needed(function: str, column) -> list[_Partial]:
    if function == "corr":
        a, b = column
        singles = [_Partial(f, x, y) for x, y in ((a, b), (b, a)) for f in ("sum", "square")]
        return [_Partial("count", a, b), *singles, _Partial("product", a, b)]
    names = {"avg": ("sum", "count"), "std": ("sum", "count", "square")}.get(function, (function,))
    return [_Partial(f, column) for f in names]


def _partials(measures: dict) -> list[_Partial]:
    return list({p.name: p for f, c in measures.values() for p in _needed(f, c)}.values())


def _final(name: str, function: str, column) -> Column:
    if function not in ("avg", "std", "corr"):
        return F.col(f"_{function}_{column}").alias(name)
    sums = [F.col(p.name).cast("double") for p in _needed(function, column)]
    if function == "avg":
        total, rows = sums
        return (total / F.nullif(rows, F.lit(0.0))).alias(name)
    if function == "std":
        total, rows, squares = sums
        spread = F.greatest(squares - total * total / rows, F.lit(0.0))
        return F.when(rows > 1, F.sqrt(spread / (rows - 1))).alias(name)
    rows, x, xx, y, yy, xy = sums
    spread = (rows * xx - x * x) * (rows * yy - y * y)
    return F.when(spread > 0, (rows * xy - x * y) / F.sqrt(spread)).alias(name)
