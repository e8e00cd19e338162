"""Forecast errors, interval quality, model comparison and classification reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.scalars import safe_divide
from tillcast.operators.quantiles import exact_quantiles

# Fixed value: smallest divisor of the percentage error (double machine epsilon).
MAPE_EPSILON = 2.220446049250313e-16


def _mean_ratio(error: Column, divisor: Column) -> Column:
    return F.avg(error / divisor) * 100


def forecast_metrics(df: DataFrame, keys: list[str], order: str = "ds", y: str = "y", p: str = "yhat"):
    """rmse, mse, mae, mape, mape_nonzero, r2, smape, mase per key over its test rows.

    ``mape`` divides by at least the machine epsilon, so a zero actual makes it huge;
    ``mape_nonzero`` leaves zero actuals out. ``mase`` compares with the previous actual value
    inside the same rows, and is NULL when those never change.
    """
    actual, predicted = F.col(y), F.col(p)
    error = F.abs(actual - predicted)
    size = F.abs(actual) + F.abs(predicted)
    step = F.abs(actual - F.lag(y).over(Window.partitionBy(*keys).orderBy(order)))
    measured = df.withColumns(
        {
            "_e": error,
            "_sq": (actual - predicted) * (actual - predicted),
            "_ape": error / F.greatest(F.abs(actual), F.lit(MAPE_EPSILON)),
            "_ape_nz": safe_divide(error, F.abs(actual)),
            "_sape": 2 * error / F.when(size == 0, F.lit(1.0)).otherwise(size),
            "_step": step,
        }
    )
    spread = F.var_pop(y) * F.count(y)
    return measured.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.sqrt(F.avg("_sq")).alias("rmse"),
        F.avg("_sq").alias("mse"),
        F.avg("_e").alias("mae"),
        (F.avg("_ape") * 100).alias("mape"),
        (F.avg("_ape_nz") * 100).alias("mape_nonzero"),
        (1 - safe_divide(F.sum("_sq"), spread)).alias("r2"),
        (F.avg("_sape") * 100).alias("smape"),
        safe_divide(F.avg("_e"), F.avg("_step")).alias("mase"),
    )


def basic_metrics(df: DataFrame, keys: list[str], y: str = "y", p: str = "yhat") -> DataFrame:
    """rmse, mae and mape over non-zero actuals (NULL when all are zero)."""
    error = F.abs(F.col(y) - F.col(p))
    return df.groupBy(*keys).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(error).alias("mae"),
        (F.avg(safe_divide(error, F.abs(F.col(y)))) * 100).alias("mape"),
    )


def compare_models(metrics: DataFrame, column: str) -> DataFrame:
    """Box-plot numbers of one metric per model: quartiles and whiskers at 1.5 spreads."""
    quartiles = exact_quantiles(metrics, ["model_type"], column, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    reach = quartiles.withColumns({"_lo": F.col("q1") - spread, "_hi": F.col("q3") + spread})
    whiskers = (
        metrics.join(reach.select("model_type", "_lo", "_hi"), "model_type")
        .where(F.col(column).between(F.col("_lo"), F.col("_hi")))
        .groupBy("model_type")
        .agg(F.min(column).alias("whisker_low"), F.max(column).alias("whisker_high"))
    )
    return quartiles.join(whiskers, "model_type").select(
        "model_type", "q1", "median", "q3", "whisker_low", "whisker_high"
    )


def fold_summary(fold_metrics: DataFrame, keys: list[str], metric: str) -> DataFrame:
    """mean, sample std, min and max of a metric over folds."""
    return fold_metrics.groupBy(*keys).agg(
        F.avg(metric).alias("mean"),
        F.stddev_samp(metric).alias("std"),
        F.min(metric).alias("min"),
        F.max(metric).alias("max"),
    )


def interval_quality(df: DataFrame, keys: list[str], y="y", low="yhat_lower", high="yhat_upper"):
    """Mean interval width and share of actual values outside."""
    outside = ~F.col(y).between(F.col(low), F.col(high))
    return df.groupBy(*keys).agg(
        F.avg(F.col(high) - F.col(low)).alias("interval_width"),
        F.avg(outside.cast("double")).alias("miscoverage_rate"),
    )


def pinball_loss(df: DataFrame, keys: list[str], q: float, y: str = "y", p: str = "yhat") -> DataFrame:
    gap = F.col(y) - F.col(p)
    return df.groupBy(*keys).agg(F.avg(F.greatest(q * gap, (q - 1) * gap)).alias("pinball"))


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, and the overall accuracy on every row."""
    counts = df.groupBy(F.col(label).alias("_l"), F.col(prediction).alias("_p")).agg(F.count("*").alias("_n"))
    sides = counts.select(
        F.explode(
            F.array(
                F.struct(F.col("_l").alias("class"), F.lit("label").alias("side")),
                F.struct(F.col("_p").alias("class"), F.lit("prediction").alias("side")),
            )
        ).alias("_s"),
        (F.col("_l") == F.col("_p")).alias("_hit"),
        "_n",
    ).select("_s.*", "_hit", "_n")
    pick = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("_n"))), F.lit(0))
    is_label, is_prediction = F.col("side") == "label", F.col("side") == "prediction"
    per_class = sides.groupBy("class").agg(
        pick(is_label & F.col("_hit")).alias("_tp"),
        pick(is_label).alias("support"),
        pick(is_prediction).alias("_predicted"),
    )
    everything = Window.partitionBy()
    precision = F.coalesce(safe_divide(F.col("_tp").cast("double"), F.col("_predicted")), F.lit(0.0))
    recall = F.coalesce(safe_divide(F.col("_tp").cast("double"), F.col("support")), F.lit(0.0))
    both = F.col("precision") + F.col("recall")
    # The window runs over one row per class.
    accuracy = F.sum("_tp").over(everything).cast("double") / F.sum("support").over(everything)
    return (
        per_class.withColumns({"precision": precision, "recall": recall, "accuracy": accuracy})
        .withColumn("f1", F.coalesce(safe_divide(2 * F.col("precision") * F.col("recall"), both), F.lit(0.0)))
        .select("class", "precision", "recall", "f1", "support", "accuracy")
    )
