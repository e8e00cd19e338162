"""Wide to long, long to wide, one-hot columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.sources.files import day_columns


def melt_days(wide: DataFrame, ids: list[str], prefix: str = "d_") -> DataFrame:
    """One row per id and day column; a missing cell stays a row with NULL."""
    return wide.unpivot(ids, day_columns(wide, prefix), "d", "sales")


def melt_series(wide: DataFrame, ds: str, series: list[str]) -> DataFrame:
    return wide.unpivot([ds], series, "ID", "y").withColumnRenamed(ds, "ds").select("ds", "y", "ID")


OTHER = "other"


def pivot_sum(
    summary: DataFrame, rows: list[str], column: str, value: str, values: list, fill=0, other: bool = True
) -> DataFrame:
    """Sums of ``value`` with one column per entry of ``values``, which the caller names.

    What is not named, NULL included, is summed in the column ``other``, so that nothing is left
    out and the columns don't depend on the data; ``other=False`` is for values that cannot be
    any others. ``fill=None`` keeps NULL. For a key that grows with the data the long form is
    the result: the grouped totals themselves.
    """
    if other:
        named = F.when(F.col(column).isin(values), F.col(column)).otherwise(OTHER)
        summary, values = summary.withColumn(column, named), [*values, OTHER]
    wide = summary.groupBy(*rows).pivot(column, values).agg(F.sum(value))
    return wide if fill is None else wide.fillna(fill, subset=[str(v) for v in values])


def one_hot(df: DataFrame, column: str, values: list, null_column: bool = False) -> DataFrame:
    """0/1 column per named value, ``column_value``, and ``column_other`` for any other;
    optionally one for NULL."""
    flags = {f"{column}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in values}
    others = F.coalesce((~F.col(column).isin(values)).cast("int"), F.lit(0))
    flags[f"{column}_{OTHER}"] = others
    if null_column:
        flags[f"{column}_nan"] = F.col(column).isNull().cast("int")
    return df.withColumns(flags).drop(column)
