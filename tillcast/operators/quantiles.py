"""Exact quantiles of groups that may be far larger than one task can hold.

``percentile`` keeps every distinct value of a group in one aggregation buffer. That is right
for a daily series (its length is bounded by the calendar), but not for a whole table or for a
group that holds a third of it. Here a sketch of bounded size, merged on the map side, brackets
every wanted rank; then one aggregate counts all rows below the bracket as one bucket and the
few values inside it one by one, and the rank is read off those counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.sources.shared import materialise

# Relative rank error of the sketch is 1 / ACCURACY; the bracket is three times as wide.
ACCURACY = 50_000
# A measured input may differ in the last bits between the two passes over it.
SLACK = 1e-9
# Brackets up to this number (under 25 MB) are broadcast, so that the rows are not shuffled.
BRACKET_ROWS = 250_000


def series_quantile(value: str | Column, q: float) -> Column:
    """Linear-interpolated quantile as an aggregate, for groups of bounded length."""
    return F.percentile(value, F.lit(q))


def exact_quantiles(
    df: DataFrame,
    by: list[str],
    value: str,
    probs: dict[str, float],
    also: Callable[[str], list[Column]] | None = None,
) -> DataFrame:
    """One row per group with one linear-interpolated quantile column per entry of ``probs``.

    NULL values are ignored; a group with only NULLs has no row. ``also`` adds aggregates of the
    value column to the first of the two passes over ``df``.
    """
    group = by or ["_all"]
    base = df if by else df.withColumn("_all", F.lit(0))
    base = base.select(*group, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    extra = also("_v") if also else []
    # One row per group, written: the brackets and the extra aggregates both come from it.
    sketched = materialise(_sketch(base, group, probs, extra), "sketches")
    brackets = _brackets(sketched, group, probs)
    if sketched.count() * len(probs) <= BRACKET_ROWS:
        brackets = F.broadcast(brackets)
    counts = _bracket_counts(base, brackets, group)
    running = Window.partitionBy(*group, "_prob").orderBy(F.asc_nulls_first("_v"))
    upto = F.sum("_n").over(running.rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumn("_upto", upto)
    columns = []
    for name in probs:
        mine = F.col("_prob") == name
        low = F.min(F.when(mine & (F.col("_upto") > F.col("_r0")), F.col("_v")))
        high = F.min(F.when(mine & (F.col("_upto") > F.col("_r1")), F.col("_v")))
        share = F.max(F.when(mine, F.col("_share")))
        inside = F.min(F.when(mine & F.col("_v").isNull(), F.col("_upto") <= F.col("_r0")))
        exact = F.coalesce(inside, F.lit(True)) & high.isNotNull()
        failed = F.raise_error(F.lit("the quantile lies outside its bracket")).cast("double")
        columns.append(F.when(exact, low + (high - low) * share).otherwise(failed).alias(name))
    result = ranked.groupBy(*group).agg(*columns)
    if extra:
        kept = [c for c in sketched.columns if c not in ("_rows", "_s", "_min", "_max", *group)]
        known = sketched.select(*[F.col(c).alias(f"_g_{c}") for c in group], *kept)
        result = result.join(known, _same_group(group)).select(*group, *kept, *probs)
    return result if by else result.drop("_all")


def _sketch(base: DataFrame, group: list[str], probs: dict[str, float], extra: list[Column]):
    margin = 3.0 / ACCURACY
    ends = [e for q in probs.values() for e in (max(0.0, q - margin), min(1.0, q + margin))]
    return base.groupBy(*group).agg(
        F.count("*").alias("_rows"),
        F.percentile_approx("_v", ends, ACCURACY).alias("_s"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        *extra,
    )


def _same_group(group: list[str]) -> Column:
    on = F.lit(True)
    for c in group:
        on = on & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return on


def _brackets(sketched: DataFrame, group: list[str], probs: dict[str, float]) -> DataFrame:
    """Per group and quantile: the zero-based ranks it needs and values around them."""
    # With few rows a rank is wider than the margin: the bracket is the whole group.
    few = F.col("_rows") <= ACCURACY
    entries = []
    for i, (name, q) in enumerate(probs.items()):
        position = F.lit(float(q)) * (F.col("_rows") - 1)
        entries.append(
            F.struct(
                F.lit(name).alias("_prob"),
                F.floor(position).alias("_r0"),
                F.ceil(position).alias("_r1"),
                (position - F.floor(position)).alias("_share"),
                _widened(F.when(few, F.col("_min")).otherwise(F.col("_s")[2 * i]), -1).alias("_lo"),
                _widened(F.when(few, F.col("_max")).otherwise(F.col("_s")[2 * i + 1]), 1).alias("_hi"),
            )
        )
    return sketched.select(*[F.col(c).alias(f"_g_{c}") for c in group], F.inline(F.array(*entries)))


def _widened(x: Column, direction: int) -> Column:
    return x + direction * (F.abs(x) * SLACK + SLACK)


def _bracket_counts(base: DataFrame, brackets: DataFrame, group: list[str]) -> DataFrame:
    """Row counts per value inside a bracket; all rows below it are counted under NULL."""
    placed = base.join(brackets, _same_group(group) & (F.col("_v") <= F.col("_hi")))
    kept = F.when(F.col("_v") >= F.col("_lo"), F.col("_v"))
    return placed.groupBy(*group, "_prob", "_r0", "_r1", "_share", kept.alias("_v")).agg(
        F.count("*").alias("_n")
    )
