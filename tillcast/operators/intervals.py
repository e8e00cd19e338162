"""Prediction intervals from residuals: quantiles, normal bands, conformal calibration.

All quantiles are taken per series, whose length is bounded by the calendar.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.operators.quantiles import series_quantile


def residual_quantiles(fitted: DataFrame, forecasts: DataFrame, keys: list[str], probs: dict[str, float]):
    """Forecast plus the quantile of training residuals, one column per entry of ``probs``."""
    residual = F.col("y") - F.col("yhat")
    columns = [series_quantile(residual, q).alias(f"_q_{name}") for name, q in probs.items()]
    offsets = fitted.groupBy(*keys).agg(*columns)
    joined = forecasts.join(offsets, keys)
    for name in probs:
        joined = joined.withColumn(name, F.col("yhat") + F.col(f"_q_{name}"))
    return joined.drop(*[f"_q_{name}" for name in probs])


def normal_band(fitted: DataFrame, forecasts: DataFrame, keys: list[str], level: float = 0.8):
    """Forecast plus/minus z standard deviations of the training residuals."""
    z = NormalDist().inv_cdf(0.5 + level / 2)
    spread = fitted.groupBy(*keys).agg(F.stddev_samp(F.col("y") - F.col("yhat")).alias("_s"))
    half = F.lit(z) * F.col("_s")
    return (
        forecasts.join(spread, keys)
        .withColumns({"yhat_lower": F.col("yhat") - half, "yhat_upper": F.col("yhat") + half})
        .drop("_s")
    )


def conformal_naive(calibration: DataFrame, forecasts: DataFrame, keys: list[str], alpha: float):
    """Forecast plus/minus the (1 - alpha) quantile of absolute calibration residuals."""
    score = F.abs(F.col("y") - F.col("yhat"))
    widths = calibration.groupBy(*keys).agg(series_quantile(score, 1 - alpha).alias("qhat"))
    return forecasts.join(widths, keys).withColumns(
        {"yhat_lower": F.col("yhat") - F.col("qhat"), "yhat_upper": F.col("yhat") + F.col("qhat")}
    )


def conformal_cqr(
    calibration: DataFrame, forecasts: DataFrame, keys: list[str], alpha: float, low="lower", high="upper"
):
    """Widen (or narrow, when negative) a quantile interval by the calibration score."""
    score = F.greatest(F.col(low) - F.col("y"), F.col("y") - F.col(high))
    widths = calibration.groupBy(*keys).agg(series_quantile(score, 1 - alpha).alias("qhat"))
    return forecasts.join(widths, keys).withColumns(
        {"yhat_lower": F.col(low) - F.col("qhat"), "yhat_upper": F.col(high) + F.col("qhat")}
    )
