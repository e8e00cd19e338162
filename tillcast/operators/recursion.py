"""Forecasts several steps ahead, each step from the ones before, as one array expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _at(values: Column, lag: int) -> Column:
    return F.element_at(values, F.lit(-lag))


def extended(
    drives: Column,
    values: Column,
    value_terms: dict[int, Column],
    errors: Column | None = None,
    error_terms: dict[int, Column] | None = None,
    levels: Column | None = None,
    d: Column | None = None,
    seasonal_d: Column | None = None,
    m: int = 1,
) -> Column:
    """The next values of a series, one for each element of ``drives``.

    A step is its drive plus, by lag, coefficients times the last ``values`` and ``errors``; future
    errors are 0. With ``levels`` the values are differences (``d`` ordinary ones, ``seasonal_d``
    over ``m`` steps, 0 or 1 each) and the levels that follow from them are returned. All histories are
    arrays in order of time, as long as the longest lag (``m + 1`` for levels).
    """
    error_terms = error_terms or {}
    doubles = lambda c: c.cast("array<double>")
    nothing = doubles(F.array())
    start = F.struct(
        doubles(values).alias("w"),
        (doubles(errors) if errors is not None else nothing).alias("e"),
        (doubles(levels) if levels is not None else nothing).alias("y"),
        nothing.alias("out"),
    )

    def step(state: Column, drive: Column) -> Column:
        value = drive
        for lag, c in value_terms.items():
            value = value + c * _at(state["w"], lag)
        for lag, c in error_terms.items():
            value = value + c * _at(state["e"], lag)
        level = value
        if levels is not None:
            y = state["y"]
            level = level + d * _at(y, 1) + seasonal_d * _at(y, m) - d * seasonal_d * _at(y, m + 1)
        return F.struct(
            F.concat(state["w"], F.array(value)).alias("w"),
            (F.concat(state["e"], F.array(F.lit(0.0))) if error_terms else state["e"]).alias("e"),
            (F.concat(state["y"], F.array(level)) if levels is not None else state["y"]).alias("y"),
            F.concat(state["out"], F.array(level)).alias("out"),
        )

    return F.aggregate(doubles(drives), start, step, lambda state: state["out"])


def in_order(rows: DataFrame, keys: list[str], ds: str, **columns: Column) -> DataFrame:
    """One row per series with arrays in order of ``ds``: the dates and each of ``columns``.
    For a bounded number of rows of a series."""
    entries = F.sort_array(F.collect_list(F.struct(ds, *[c.alias(n) for n, c in columns.items()])))
    listed = rows.groupBy(*keys).agg(entries.alias("_rows"))
    return listed.select(*keys, *[F.col("_rows")[n].alias(n) for n in (ds, *columns)])
