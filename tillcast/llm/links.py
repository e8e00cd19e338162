"""Lookups by key whose hot keys are spread, and connected components of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.frames import discard, materialise

#: A key is hot when it has more than this share of the rows, so fewer keys than its inverse are.
HOT_SHARE = 1 / 1000
#: Narrow rows of one key that a task reads without harm.
HOT_ROWS = 2_000


def hot_keys(rows: DataFrame, key: str, total: int) -> DataFrame | None:
    """``key, n`` of the keys with more than a thousandth of the ``total`` rows and more than
    ``HOT_ROWS``: fewer than a thousand rows, written. None where there is none."""
    bar = max(HOT_ROWS, int(total * HOT_SHARE))
    if total <= bar:
        return None
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    hot = materialise(counts.where(F.col("n") > bar), "hot-keys")
    return None if hot.isEmpty() else hot


def looked_up(rows: DataFrame, lookup: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``lookup``, which has one row for each key.

    Rows of hot keys meet a broadcast of their lookup rows (fewer than a thousand); the others
    are shuffled by key. Both tables are read more than once and should be written ones.
    """
    hot = hot_keys(rows, key, rows.count())
    if hot is None:
        return rows.join(lookup, key, how)
    hot = F.broadcast(hot.select(key))
    common = rows.join(hot, key, "left_anti").join(lookup, key, how)
    spread = rows.join(hot, key, "left_semi").join(
        F.broadcast(lookup.join(hot, key, "left_semi")), key, how
    )
    return common.unionByName(spread)


#: Vertices up to this number (16 MB) meet the edges as a broadcast; beyond it they are looked up.
BROADCAST_ROWS = 1_000_000


def _starred(edges: DataFrame, larger: bool, name: str) -> DataFrame:
    """One step: every vertex ties its larger neighbours, or itself and its smaller ones, to the
    smallest vertex among its neighbours and itself. Edges go from the larger vertex to the smaller."""
    both = edges
    if larger:
        both = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    if edges.count() <= BROADCAST_ROWS // 2:
        tied = both.join(F.broadcast(least), "u")
    else:
        tied = looked_up(both, materialise(least, f"{name}-least"), "u")
    if larger:
        found = tied.where("v > u").selectExpr("v AS u", "m AS v")
    else:
        # The edge to the smallest vertex stands for the vertex itself.
        found = tied.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
    return materialise(found.distinct(), f"{name}-edges")


def _is_done(edges: DataFrame) -> bool:
    """Whether every larger vertex has one edge and is no smaller vertex."""
    ends = edges.select("u", F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("u"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    seen = ends.groupBy("u").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return seen.where((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0))).isEmpty()


def connected(links: DataFrame, name: str = "links") -> DataFrame:
    """``node, component`` of every node of ``links`` (``a, b``, any type with an order); the
    component is its smallest node.

    Alternates two steps that keep the components: every vertex ties its larger neighbours to
    its smallest one, then its smaller ones. Each is a grouping and a lookup; the number of
    steps grows with the logarithm of the longest path. It ends when every vertex has one edge,
    to its component. Links to itself, repeated links and an empty table are fine.
    """
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    edges = materialise(edges.distinct(), f"{name}-edges")
    while not _is_done(edges):
        wide = _starred(edges, True, name)
        discard(edges)
        edges = _starred(wide, False, name)
        discard(wide)
    centres = edges.selectExpr("v AS u", "v").distinct()
    return edges.unionByName(centres).selectExpr("u AS node", "v AS component")
