"""Augmented Dickey-Fuller test for all series at once.

The daily change is regressed on the previous value and on the changes before it. One sum of
column products with all lags serves every number of lags: each is a subset of the columns, and
the one with the lowest AIC on common rows is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.operators import normal_equations as ne

# MacKinnon's response surface (1994) of the test with a constant: the statistic at
# which the two polynomials meet, its range, and the polynomials, lowest power first.
MEET, LEAST, MOST = -1.61, -18.83, 2.74
SMALL = (2.1659, 1.4412, 0.038269)
LARGE = (1.7339, 0.93202, -0.12745, -0.010368)


def p_value(t: float) -> float:
    """Probability of a statistic this low under a unit root."""
    if not math.isfinite(t):
        return math.nan
    if t >= MOST:
        return 1.0
    if t <= LEAST:
        return 0.0
    powers = SMALL if t <= MEET else LARGE
    value = sum(c * t**k for k, c in enumerate(powers))
    return 0.5 * (1.0 + math.erf(value / math.sqrt(2.0)))


def _testing(keys: list[str], candidates: list[int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            gram, rhs, yy, n = ne.stacked(batch)
            score, best = np.full(len(batch), np.inf), np.full(len(batch), candidates[0])
            statistic = np.full(len(batch), np.nan)
            for lags in candidates:
                some, right = gram[:, : 2 + lags, : 2 + lags], rhs[:, : 2 + lags]
                beta = ne.solved(some, right)
                rss = ne.residual_squares(some, right, yy, beta)
                room = n - 2 - lags
                aic = n * np.log(np.maximum(rss / n, 1e-300)) + 2 * (2 + lags)
                # The variance of the value's coefficient, once the other columns are out of it.
                rest = [0, *range(2, 2 + lags)]
                by_rest = np.linalg.solve(
                    some[:, rest][:, :, rest] + 1e-12 * np.eye(len(rest)), some[:, rest, 1][..., None]
                )[..., 0]
                own = some[:, 1, 1] - np.einsum("si,si->s", by_rest, some[:, rest, 1])
                with np.errstate(divide="ignore", invalid="ignore"):
                    t = beta[:, 1] / np.sqrt(rss / room / own)
                usable = (room > 0) & (own > 1e-9 * some[:, 1, 1]) & (rss > 1e-12 * np.maximum(yy, 1e-300))
                better = usable & (aic < score - 1e-9)
                score[better], best[better], statistic[better] = aic[better], lags, t[better]
            out = batch[keys].copy()
            out["n"], out["lags"] = n.astype(np.int64), best.astype(np.int32)
            out["adf_statistic"] = statistic
            out["p_value"] = [p_value(t) for t in statistic]
            yield out

    return run


def augmented(
    series: DataFrame, keys: list[str], most: int = 8, fixed: int | None = None, level: float = 0.05
) -> DataFrame:
    """``keys, n, lags, adf_statistic, p_value, suggested_d`` of every series of ``ds, y``.

    ``lags`` is chosen among 0 to ``most``, or ``fixed``. A series that is constant or too short
    has no statistic (NULL) and suggests 1 difference, as one with a p-value of ``level`` or more does.
    """
    order = Window.partitionBy(*keys).orderBy("ds")
    deepest = most if fixed is None else fixed
    change = F.col("y") - F.lag("y").over(order)
    rows = series.select(*keys, "ds", "y", F.lag("y").over(order).alias("_x"), change.alias("_dy"))
    rows = rows.withColumn("_z", F.array(*[F.lag("_dy", k).over(order) for k in range(1, deepest + 1)]))
    columns = [F.lit(1.0), F.col("_x"), *[F.col("_z")[k] for k in range(deepest)]]
    sums = ne.product_sums(rows, keys, columns, F.col("_dy"))
    schema = f"{ne.key_types(series, keys)}, n long, lags int, adf_statistic double, p_value double"
    tested = sums.mapInPandas(_testing(keys, list(range(most + 1)) if fixed is None else [fixed]), schema)
    known = {c: F.when(~F.isnan(c), F.col(c)) for c in ("adf_statistic", "p_value")}
    return tested.withColumns(known).withColumn(
        "suggested_d", F.when(F.col("p_value") < level, 0).otherwise(1)
    )
