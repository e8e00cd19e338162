"""Saturating growth: a logistic trend with a capacity, and seasons and regressors around it.

The trend is capacity / (1 + exp(-rate * (t - midpoint))), t in scaled time. It is fitted by
damped Gauss-Newton steps from sums over the days of each series (nine of them and the loss),
all series in one aggregation for each step and without Python. A step that raises the loss is
taken back and damped more. What the trend leaves is fitted by the decomposable model.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.operators import decomposable
from tillcast.operators.decomposable import Config, Design
from tillcast.sources.shared import materialise

STEPS = 20
#: Steps end where no series improves its loss by more than this share.
SMALL_CHANGE = 1e-7
_SUMS = ["hcc", "hca", "hck", "haa", "hak", "hkk", "gc", "ga", "gk"]
_STATE = ["_c", "_a", "_k", "_loss", *_SUMS]


def _logistic(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def growth(t: Column) -> Column:
    """The trend at scaled time ``t`` from the model columns."""
    return F.col("capacity") * _logistic(F.col("rate") * (t - F.col("midpoint")))


def _scaled_time() -> Column:
    return F.datediff(F.col("ds"), F.col("t0")) / F.col("span")


def _evaluated(rows: DataFrame, tried: DataFrame, keys: list[str], capacity: str) -> DataFrame:
    """Loss, products of the derivatives, and products with what is left, at the tried values."""
    at = rows.join(tried.select(*keys, "_c", "_a", "_k"), keys)
    s = _logistic(F.col("_a") + F.col("_k") * F.col("t"))
    at = at.withColumns({"_s": s, "_r": F.col("y") - F.col("_c") * s})
    slope = F.col("_c") * F.col("_s") * (1 - F.col("_s"))
    dc = F.lit(0.0) if capacity == "largest" else F.col("_s")
    at = at.withColumns({"_dc": dc, "_da": slope, "_dk": slope * F.col("t")})
    product = lambda x, y: F.sum(F.col(x) * F.col(y))
    return at.groupBy(*keys).agg(
        F.first("_c").alias("_c"), F.first("_a").alias("_a"), F.first("_k").alias("_k"),
        product("_r", "_r").alias("_loss"),
        product("_dc", "_dc").alias("hcc"), product("_dc", "_da").alias("hca"),
        product("_dc", "_dk").alias("hck"), product("_da", "_da").alias("haa"),
        product("_da", "_dk").alias("hak"), product("_dk", "_dk").alias("hkk"),
        product("_dc", "_r").alias("gc"), product("_da", "_r").alias("ga"),
        product("_dk", "_r").alias("gk"),
    )


def _stepped() -> dict[str, Column]:
    """The next values to try: three damped normal equations, solved by determinants."""
    damped = lambda h: F.col(h) * (1 + F.col("damping")) + F.lit(1e-12)
    a, b, c = damped("hcc"), F.col("hca"), F.col("hck")
    e, f, i = damped("haa"), F.col("hak"), damped("hkk")
    x, y, z = F.col("gc"), F.col("ga"), F.col("gk")
    det = a * (e * i - f * f) - b * (b * i - f * c) + c * (b * f - e * c)
    by_c = x * (e * i - f * f) - b * (y * i - f * z) + c * (y * f - e * z)
    by_a = a * (y * i - f * z) - x * (b * i - f * c) + c * (b * z - y * c)
    by_k = a * (e * z - y * f) - b * (b * z - y * c) + x * (b * f - e * c)
    moved = lambda value, by: F.col(value) + F.coalesce(by / F.nullif(det, F.lit(0.0)), F.lit(0.0))
    return {"_c": moved("_c", by_c), "_a": moved("_a", by_a), "_k": moved("_k", by_k)}


def fit_growth(train: DataFrame, keys: list[str], capacity: str = "fitted") -> DataFrame:
    """Per series: ``t0, span, capacity, rate, midpoint, loss, converged``.

    ``capacity`` is fitted, or the ``largest`` training value. The start is a straight line through
    the log-odds of the values. Where the data have no bend the steps may not settle; ``converged``
    says so, and the best values found stay. A series without a positive value has capacity 0.
    """
    scaling = decomposable.series_scaling(train, keys).select(*keys, "t0", "span")
    rows = train.select(*keys, "ds", F.col("y").cast("double").alias("y")).join(scaling, keys)
    rows = materialise(
        rows.where(F.col("y").isNotNull()).select(*keys, _scaled_time().alias("t"), "y"), "growth"
    )
    largest = rows.groupBy(*keys).agg(F.greatest(F.max("y"), F.lit(0.0)).alias("_c"))
    most = F.col("_c") * 1.05
    odds = F.when((F.col("y") > 0) & (F.col("y") < most), F.ln(F.col("y") / (most - F.col("y"))))
    lined = rows.join(largest, keys).withColumn("_odds", odds)
    line = lined.groupBy(*keys).agg(
        F.first("_c").alias("_c"),
        F.coalesce(F.regr_intercept("_odds", "t"), F.lit(0.0)).alias("_a"),
        F.coalesce(F.regr_slope("_odds", "t"), F.lit(0.0)).alias("_k"),
    )
    best = _evaluated(rows, materialise(line, "growth-start"), keys, capacity)
    gain = F.when(F.col("_loss") > 0, 1.0).otherwise(0.0)
    best = best.withColumns({"damping": F.lit(0.01), "gain": gain})
    best = materialise(best, "growth-step")
    for _ in range(STEPS):
        tried = best.withColumns(_stepped())
        new = _evaluated(rows, tried, keys, capacity).select(
            *keys, *[F.col(n).alias(f"new_{n}") for n in _STATE]
        )
        both = best.join(new, keys)
        better = F.col("new__loss") < F.col("_loss")  # NaN is above all
        gain = F.when(better, (F.col("_loss") - F.col("new__loss")) / F.col("_loss")).otherwise(0.0)
        kept = {n: F.when(better, F.col(f"new_{n}")).otherwise(F.col(n)) for n in _STATE}
        damping = F.when(better, F.col("damping") / 5).otherwise(F.col("damping") * 10)
        chosen = both.select(
            *keys,
            *[c.alias(n) for n, c in kept.items()],
            damping.alias("damping"),
            # A step taken back says nothing yet about convergence, one with hardly any effect does.
            F.when(better | (F.col("damping") > 1e6), gain).otherwise(F.col("gain")).alias("gain"),
        )
        best = materialise(chosen, "growth-step")
        if best.where(F.col("gain") > SMALL_CHANGE).isEmpty():
            break
    k = F.nullif(F.col("_k"), F.lit(0.0))
    return scaling.join(best, keys).select(
        *keys, "t0", "span", F.col("_c").alias("capacity"), F.coalesce(k, F.lit(1e-9)).alias("rate"),
        (-F.col("_a") / F.coalesce(k, F.lit(1e-9))).alias("midpoint"), F.col("_loss").alias("loss"),
        (F.col("gain") <= SMALL_CHANGE).alias("converged"),
    )


def fit(train: DataFrame, keys: list[str], design: Design, config: Config | None = None, capacity: str = "fitted"):
    """Model rows: those of the decomposable model for what the growth leaves, and its
    ``capacity``, ``rate`` and ``midpoint``. The design's own trend is a constant."""
    curve = materialise(fit_growth(train, keys, capacity), "growth-models")
    left = train.join(curve.select(*keys, "t0", "span", "capacity", "rate", "midpoint"), keys)
    left = left.withColumn("y", F.col("y") - growth(_scaled_time()))
    left = left.drop("t0", "span", "capacity", "rate", "midpoint")
    config = replace(config or Config(), slope=False)
    around = decomposable.fit(left, keys, replace(design, changepoints=0), config)
    return around.join(curve.select(*keys, "capacity", "rate", "midpoint", "converged"), keys)


def score(frame: DataFrame, models: DataFrame, keys: list[str], design: Design, floor: float = 0.0) -> DataFrame:
    """``frame`` with ``growth``, the components around it and ``yhat``, at least ``floor`` and at
    most the capacity."""
    joined = frame.join(models, keys)
    joined = joined.withColumn("growth", growth(_scaled_time()))
    scored = decomposable.score(joined, None, keys, replace(design, changepoints=0), clamp=False)
    total = F.col("growth") + F.col("yhat")
    return scored.withColumn(
        "yhat", F.greatest(F.lit(floor), F.least(total, F.col("capacity")))
    ).drop("rate", "midpoint", "converged", "last_date", "config", "params")
