"""Writers: Parquet, CSV, append and replace modes, metrics and model tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast import schemas


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_repartitioned(df: DataFrame, path: str, files: int) -> None:
    """Write a fixed number of files of even size (round robin, so no key can be hot)."""
    df.repartition(files).write.mode("overwrite").parquet(path)


def rows_per_partition(df: DataFrame) -> DataFrame:
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows"))


def write_by_year(df: DataFrame, path: str, replace_all: bool) -> None:
    """One folder per year. Without ``replace_all`` only the years present in ``df`` are
    replaced, so loading a year twice gives the same table."""
    writer = df.withColumn("year", F.year("date")).write.mode("overwrite").partitionBy("year")
    writer.option("partitionOverwriteMode", "static" if replace_all else "dynamic").parquet(path)


def append_forecasts(df: DataFrame, path: str) -> None:
    """Append forecasts without the actual values; new columns may appear later."""
    df.drop("actual_sales").write.mode("append").parquet(path)


def write_forecast_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


METRIC_COLUMNS = ["rmse", "mse", "mae", "mape", "r2", "smape", "mase"]


def metrics_rows(metrics: DataFrame, params: DataFrame, keys: list[str]) -> DataFrame:
    """One row per series: seven metrics and the parameters of the chosen model as a map."""
    on = [*keys, "model_type"]
    return metrics.join(params, on, "left").select(*on, *METRIC_COLUMNS, "params")


def write_metrics(df: DataFrame, path: str) -> None:
    schemas.require_columns(df, ["model_type", *METRIC_COLUMNS, "params"])
    df.write.mode("overwrite").parquet(path)


def write_models(df: DataFrame, path: str) -> None:
    """Fitted models as rows: coefficients and parameters, keyed by model type and series."""
    schemas.require_columns(df, ["model_type", "last_date", "coefficients", "params"])
    df.write.mode("overwrite").partitionBy("model_type").parquet(path)
