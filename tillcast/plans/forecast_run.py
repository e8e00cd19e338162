"""The forecast run: from daily totals to the best forecast per series and its roll-ups."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.operators import cell_mean, decomposable, seasonal_arma, selection, series, whole_series, windows
from tillcast.operators.aggregates import rollup_forecast
from tillcast.operators.decomposable import Design
from tillcast.operators.evaluation import forecast_metrics
from tillcast.operators.rows import rows_of_items
from tillcast.sources.shared import materialise
from tillcast.sources.sinks import metrics_rows


@dataclass(frozen=True)
class RunResult:
    forecasts: DataFrame
    metrics: DataFrame
    status: DataFrame
    models: DataFrame

    def rollup(self, *dims: str) -> DataFrame:
        return rollup_forecast(self.forecasts, list(dims))


def top_series(daily: DataFrame, within: str, item: str, n: int) -> DataFrame:
    """Rows of the ``n`` best-selling items of every store, for all stores at once."""
    totals = daily.groupBy(within, item).agg(F.sum("sales").alias("total_sales"))
    best = windows.top_n_per_group(totals, [within], "total_sales", item, n)
    return daily.join(best.select(within, item), [within, item], "left_semi")


def clean_series(daily: DataFrame, keys: list[str]) -> DataFrame:
    """All series as rows of ``whole_series``. Those without a NULL in their keys that are not mostly
    empty are ``kept``; outlier days become 0."""
    named = reduce(and_, [F.col(k).isNotNull() for k in keys], F.lit(True))
    return whole_series.cleaned(daily, keys).withColumn("kept", F.col("kept") & named)


def screened(daily: DataFrame, keys: list[str], threshold: float = 0.9) -> DataFrame:
    """``keys, n, zero_ratio, status`` of every series: ``mostly zero`` above the threshold, else
    ``ok``. ``n`` counts its days, those without a row included."""
    dense = series.daily_series(daily, keys, flags=False)
    shares = series.zero_ratio(dense, keys)
    counted = dense.groupBy(*keys).agg(F.count("*").alias("n")).join(shares, keys)
    status = F.when(F.col("zero_ratio") > threshold, "mostly zero").otherwise("ok")
    return counted.withColumn("status", status)


def all_forecasts(train: DataFrame, test: DataFrame, keys: list[str], models: DataFrame, design: Design, days: int):
    """Long frame of the three models' forecasts of the ``days`` test days after whole training series,
    whose column ``actual`` has those days' values; ``y`` in the result."""
    columns = [*keys, "ds", "y", "yhat"]
    first = decomposable.score(test, models, keys, design).select(*columns)
    second = seasonal_arma.forecast_whole(train, keys, days, actual="actual").select(*columns)
    until = train.withColumn("_until", whole_series.as_date(F.col("last")))
    means = cell_mean.fit(whole_series.sold_days(until, keys, "_until"), keys, until="_until")
    third = cell_mean.score(test, means, keys).select(*columns)
    tagged = [
        frame.withColumn("model_type", F.lit(name))
        for frame, name in zip((first, second, third), selection.MODEL_PRIORITY)
    ]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


def run(daily: DataFrame, keys: list[str], test_days: int = 28, design: Design | None = None) -> RunResult:
    """``daily`` has the keys, ``date`` and ``sales``.

    The cleaned series and the fitted models are written once to the shared folder, because the
    tuning, three models and the metrics all read them. A series is one row, so that only its days
    with sales are exchanged, and only once.
    """
    design = design or Design()
    every = materialise(clean_series(daily, keys), "series")
    cleaned = every.where("kept")
    marked = cleaned.withColumn("actual", whole_series.tail(test_days))
    train = whole_series.upto(marked, F.col("last") - test_days)
    test = whole_series.last_days(cleaned, keys, test_days)
    models = materialise(decomposable.fit_tuned_whole(train, keys, design), "models")
    forecasts = materialise(all_forecasts(train, test, keys, models, design, test_days), "forecasts")
    compared = forecasts.where(~F.isnan("yhat"))
    metrics = materialise(forecast_metrics(compared, [*keys, "model_type"]), "metrics")
    best = selection.select_best(metrics, keys)
    chosen = forecasts.join(best.select(*keys, "model_type"), [*keys, "model_type"], "left_semi")
    frame = selection.forecast_frame(chosen, None, keys)
    tuned = models.select(F.lit("decomposable").alias("model_type"), *keys, "params")
    best_metrics = metrics.join(best.select(*keys, "model_type"), [*keys, "model_type"], "left_semi")
    status = selection.series_status(every, best, keys)
    return RunResult(frame, metrics_rows(best_metrics, tuned, keys), status, models)
