"""Choosing among models, aligning forecasts with actual values, scoring requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions.dates import with_calendar_flags
from tillcast.operators import cell_mean
from tillcast.operators.decomposable import Design, score

# Order of preference where models are equally good.
MODEL_PRIORITY = ("decomposable", "seasonal_ar", "cell_mean")


def model_priority(model_type: Column) -> Column:
    names = F.array(*[F.lit(m) for m in MODEL_PRIORITY])
    position = F.array_position(names, model_type)
    return F.when(position == 0, len(MODEL_PRIORITY) + 1).otherwise(position)


def select_best(metrics: DataFrame, keys: list[str], metric: str = "mape") -> DataFrame:
    """The model with the lowest metric per series; on a tie the preferred, then by name."""
    order = F.struct(F.col(metric), model_priority(F.col("model_type")), F.col("model_type"))
    usable = metrics.where(F.col(metric).isNotNull())
    return usable.groupBy(*keys).agg(
        F.min_by("model_type", order).alias("model_type"), F.min(metric).alias(metric)
    )


def series_status(all_series: DataFrame, best: DataFrame, keys: list[str]) -> DataFrame:
    """Every series with its chosen model, or the status ``no model``."""
    joined = all_series.select(*keys).distinct().join(best, keys, "left")
    status = F.when(F.col("model_type").isNull(), "no model").otherwise("ok")
    return joined.withColumn("status", status)


def first_available(forecasts: DataFrame, keys: list[str]) -> DataFrame:
    """One forecast per series and date: the preferred model's, else the next one that has a
    value. ``forecasts`` is long, with ``model_type`` and a possibly NULL ``yhat``."""
    usable = forecasts.where(F.col("yhat").isNotNull() & ~F.isnan("yhat"))
    order = F.struct(model_priority(F.col("model_type")), F.col("model_type"))
    return usable.groupBy(*keys, "ds").agg(
        F.min_by("yhat", order).alias("yhat"), F.min_by("model_type", order).alias("model_type")
    )


def forecast_frame(forecasts: DataFrame, actual: DataFrame | None, keys: list[str]) -> DataFrame:
    """``date, forecast_sales, actual_sales`` and the keys, where both sides have the date. Without
    ``actual`` the forecasts have the actual values as ``y``."""
    if actual is None:
        joined = forecasts.withColumnRenamed("y", "actual_sales")
    else:
        joined = forecasts.join(actual.select(*keys, "ds", F.col("y").alias("actual_sales")), [*keys, "ds"])
    return joined.select(
        F.col("ds").alias("date"), F.col("yhat").alias("forecast_sales"), "actual_sales", *keys
    )


def decomposable_rows(models: DataFrame, keys: list[str]) -> DataFrame:
    """Fitted decomposable models in the layout of the model table."""
    params = F.map_concat(
        "params",
        F.create_map(
            F.lit("t0"), F.col("t0").cast("string"),
            F.lit("span"), F.col("span").cast("string"),
            F.lit("cap"), F.col("cap").cast("string"),
        ),
    )
    return models.select(F.lit("decomposable").alias("model_type"), *keys, "last_date", "coefficients", params.alias("params"))


def cell_mean_rows(models: DataFrame, keys: list[str]) -> DataFrame:
    empty = F.create_map().cast("map<string,string>")
    return models.select(F.lit("cell_mean").alias("model_type"), *keys, "last_date", "coefficients", empty.alias("params"))


def batch_score(requests: DataFrame, models: DataFrame, keys: list[str], design: Design) -> DataFrame:
    """The next ``steps`` values for each requested series from its stored model.

    The decomposable model is used where there is one, otherwise the cell means. A request for
    a series without a model comes back as one row with a status.
    """
    order = model_priority(F.col("model_type"))
    stored = models.groupBy(*keys).agg(
        F.min_by(F.struct("model_type", "last_date", "coefficients", "params"), order).alias("_m")
    )
    joined = requests.join(stored, keys, "left").select(*keys, "steps", "_m.*")
    ahead = F.sequence(F.date_add("last_date", 1), F.date_add("last_date", F.col("steps")))
    # A request without a model keeps one row, with a NULL date.
    days = with_calendar_flags(joined.select("*", F.explode_outer(ahead).alias("ds")))
    seasonal, means = F.col("model_type") == "decomposable", F.col("model_type") == "cell_mean"
    fields = days.withColumns(
        {
            "_means": F.when(means, F.col("coefficients")),
            "coefficients": F.when(seasonal, F.col("coefficients")),
            "t0": F.col("params")["t0"].cast("date"),
            "span": F.col("params")["span"].cast("double"),
            "cap": F.col("params")["cap"].cast("double"),
            "mode": F.col("params")["seasonality_mode"],
        }
    )
    scored = score(fields, None, keys, design)
    yhat = F.when(seasonal, F.col("yhat")).when(means, cell_mean.predicted(F.col("_means")))
    status = F.when(F.col("model_type").isNull(), "unknown series").otherwise("ok")
    return scored.select(*keys, "ds", yhat.alias("yhat"), "model_type", status.alias("status"))
