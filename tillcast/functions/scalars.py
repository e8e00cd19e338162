"""Small column expressions shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp_non_negative(x: Column) -> Column:
    return F.greatest(F.lit(0.0), x)


def safe_divide(a: Column, b: Column) -> Column:
    """NULL where the divisor is zero or NULL."""
    return a / F.nullif(b, F.lit(0))


def exact_mean(x: Column) -> Column:
    """Mean as an aggregate: sum over count. Integer and decimal sums are exact, so the result
    does not depend on the order in which rows meet."""
    return F.sum(x).cast("double") / F.nullif(F.count(x), F.lit(0))


def coerce_double(x: Column) -> Column:
    return x.try_cast("double")


def coerce_date(x: Column) -> Column:
    return F.try_to_timestamp(x).cast("date")


def kelvin_to_fahrenheit(x: Column) -> Column:
    return (x - F.lit(273.15)) * F.lit(1.8) + F.lit(32)


def normalise_name(x: Column) -> Column:
    return F.replace(x, F.lit(" "), F.lit("_"))


def null_safe_match(left: list[Column], right: list[Column]) -> Column:
    """Equality over several columns in which NULL matches NULL."""
    pairs = [a.eqNullSafe(b) for a, b in zip(left, right)]
    return reduce(lambda x, y: x & y, pairs)


def significant(x: Column, digits: int = 10) -> Column:
    """Round to a number of significant digits, for values of any magnitude."""
    return F.format_string(f"%.{digits - 1}e", x).cast("double")
