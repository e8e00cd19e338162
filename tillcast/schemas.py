"""Fixed schemas of the input and result tables, and the guards that use them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "array<double>": T.ArrayType(T.DoubleType()),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
}


def _struct(spec: str) -> T.StructType:
    """``"name type, name type"`` as a schema; unlike DDL text it needs no running session."""
    pairs = [part.split(" ", 1) for part in spec.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SALES_ID_COLUMNS = ["id", "item", "category", "department", "store", "store_code", "region"]

SALES_LONG = _struct(
    "id string, item string, category string, department string, store string, "
    "store_code string, region string, d string, sales int"
)

CALENDAR = _struct("date date, d string, event string")

PRICES = _struct(
    "item string, category string, store_code string, yearweek double, sell_price double"
)

FACT = _struct(
    "id string, item string, category string, category_price string, department string, "
    "store string, store_code string, region string, d string, sales int, yearweek int, "
    "date date, event string, sell_price double"
)

EVENTS = _struct("event string, ds date, lower_window int, upper_window int")

def sales_wide_schema(n_days: int) -> T.StructType:
    """Schema of the wide sales file: seven id columns, then ``d_1 .. d_n``."""
    ids = [T.StructField(c, T.StringType()) for c in SALES_ID_COLUMNS]
    days = [T.StructField(f"d_{i}", T.IntegerType()) for i in range(1, n_days + 1)]
    return T.StructType(ids + days)


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Return ``df`` unchanged, or raise while the plan is being built."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df
