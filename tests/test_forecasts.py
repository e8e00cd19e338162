"""Forecasting, segmentation and classification jobs: planted truths and properties."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.functions.dates import with_calendar_flags
from tillcast.operators import cell_mean, collecting, decomposable, forests, seasonal_ar, segments, selection, series
from tillcast.operators.decomposable import Config, Design
from tillcast.plans import forecast_run

D0 = dt.date(2019, 1, 7)


def planted(spark, keys=("a", "b", "c"), n=400, partitions=5, scale=1.0):
    """2 + 0.1 t + 5 sin(2 pi t / 7), shifted up so that no value is negative."""
    rows = [
        (k, D0 + dt.timedelta(days=t), scale * (12 + 0.1 * t + 5 * math.sin(2 * math.pi * t / 7)))
        for k in keys
        for t in range(n)
    ]
    df = spark.createDataFrame(rows, "k string, ds date, y double").repartition(partitions)
    return with_calendar_flags(df)


def split(df, days=28):
    marked = series.split_tail_days(df, ["k"], days)
    return marked.where("split = 'train'").drop("split"), marked.where("split = 'test'").drop("split")


def worst_error(scored):
    return scored.agg(F.max(F.abs(F.col("y") - F.col("yhat")) / F.col("y"))).first()[0]


def test_planted_trend_and_season_are_found(spark):
    train, test = split(planted(spark))
    design = Design(yearly_order=0)
    models = decomposable.fit(train, ["k"], design)
    scored = decomposable.score(test, models, ["k"], design, clamp=False)
    assert scored.count() == 3 * 28
    assert worst_error(scored) < 0.02
    parts = scored.withColumn("total", sum((F.col(g) for g in design.groups()), F.lit(0.0)))
    assert parts.agg(F.max(F.abs(F.col("total") - F.col("yhat")))).first()[0] < 1e-9


def test_products_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(decomposable, "_HELD_KEYS", 2)
    design = Design(changepoints=3, yearly_order=0, weekly_order=1, regressors=())
    got = []
    for parts in (1, 7):
        framed = decomposable.training_frame(planted(spark, n=60, keys="abcde", partitions=parts), ["k"])
        rows = decomposable.column_products(framed, ["k"], design).orderBy("k").collect()
        got.append(np.array([r["gram"] for r in rows]))
        assert [r["n"] for r in rows] == [60] * 5
    assert np.allclose(got[0], got[1])


def test_forecast_is_clamped_to_the_cap(spark):
    train, test = split(planted(spark))
    models = decomposable.fit(train, ["k"], Design(yearly_order=0))
    scored = decomposable.score(test, models, ["k"], Design(yearly_order=0))
    highest = train.agg(F.max("y")).first()[0]
    assert scored.agg(F.max("yhat")).first()[0] <= highest + 1e-9


def test_multiplicative_mode(spark):
    df = planted(spark).withColumn("y", F.exp(F.col("y") / 20) * 10)
    train, test = split(df)
    design = Design(yearly_order=0)
    models = decomposable.fit(train, ["k"], design, Config(mode="multiplicative"))
    assert worst_error(decomposable.score(test, models, ["k"], design, clamp=False)) < 0.03


def test_tuning_switches_the_week_on_and_is_the_argmin(spark):
    train, _ = split(planted(spark, keys=("a", "b")))
    design = Design(yearly_order=2)
    grid = [Config(weekly=False, yearly=False), Config(weekly=True, yearly=False)]
    best = decomposable.tune(train, ["k"], design, configs=grid).collect()
    assert {r["config"] for r in best} == {1}
    models = decomposable.fit_tuned(train, ["k"], design, configs=grid).collect()
    assert all(r["params"]["weekly_seasonality"] == "true" for r in models)


def test_one_global_model_fits_series_of_different_size(spark):
    df = planted(spark, keys=("a",)).unionByName(
        planted(spark, keys=("big",), scale=100.0)
    )
    train, test = split(df)
    design = Design(yearly_order=0)
    models = decomposable.fit(train, ["k"], design, scope="global")
    assert models.select("coefficients").distinct().count() == 1
    assert worst_error(decomposable.score(test, models, ["k"], design, clamp=False)) < 0.02


def test_shared_season_with_own_trends(spark):
    up = planted(spark, keys=("up",))
    flat = planted(spark, keys=("flat",)).withColumn("y", F.col("y") - 0.1 * F.datediff("ds", F.lit(D0)) + 30)
    train, test = split(up.unionByName(flat))
    design = Design(yearly_order=0)
    models = decomposable.fit_global_season(train, ["k"], design)
    assert worst_error(decomposable.score(test, models, ["k"], design, clamp=False)) < 0.1


def test_autoregression_continues_a_planted_series(spark):
    marked = series.split_tail_days(planted(spark, keys=("a", "b")), ["k"], 14)
    out = seasonal_ar.forecast(marked, ["k"])
    joined = out.join(marked.select("k", "ds", "y"), ["k", "ds"])
    assert joined.count() == 28 and worst_error(joined) < 0.05
    both = seasonal_ar.forecast(marked, ["k"], regressors=[], d=1, seasonal_d=1)
    assert worst_error(both.join(marked.select("k", "ds", "y"), ["k", "ds"])) < 0.05


def test_too_short_series_get_a_status(spark):
    marked = series.split_tail_days(planted(spark, keys=("a",), n=10), ["k"], 4)
    out = seasonal_ar.forecast(marked, ["k"]).collect()
    assert {r["status"] for r in out} == {"too short"} and len(out) == 4


def test_cell_means_fall_back(spark):
    train = with_calendar_flags(
        spark.createDataFrame([("s", dt.date(2020, 1, 6 + i), float(10 * i)) for i in range(3)], "k string, ds date, y double")
    )
    days = [dt.date(2020, 1, 13), dt.date(2020, 12, 28), dt.date(2020, 1, 16)]
    ask = with_calendar_flags(spark.createDataFrame([("s", d) for d in days], "k string, ds date"))
    christmas = with_calendar_flags(spark.createDataFrame([("s", dt.date(2019, 12, 24))], "k string, ds date"))
    models = cell_mean.fit(train, ["k"])
    got = {r["ds"]: r["yhat"] for r in cell_mean.score(ask.unionByName(christmas), models, ["k"]).collect()}
    assert got[days[0]] == 0.0  # the cell of Mondays
    assert got[dt.date(2019, 12, 24)] == 10.0  # no such December day: the mean of Tuesdays
    assert got[days[2]] == 10.0  # no Thursday: the mean of the series


def test_best_model_is_the_argmin_with_a_stated_tie(spark):
    metrics = spark.createDataFrame(
        [("s", "cell_mean", 1.0), ("s", "decomposable", 1.0), ("t", "cell_mean", 0.5), ("t", "seasonal_ar", 0.7), ("u", "cell_mean", None)],
        "k string, model_type string, mape double",
    )
    best = selection.select_best(metrics, ["k"])
    assert {(r["k"], r["model_type"]) for r in best.collect()} == {("s", "decomposable"), ("t", "cell_mean")}
    status = {r["k"]: r["status"] for r in selection.series_status(metrics, best, ["k"]).collect()}
    assert status == {"s": "ok", "t": "ok", "u": "no model"}


def test_requests_use_the_preferred_model_and_report_unknown_series(spark):
    train, test = split(planted(spark, keys=("a", "b")))
    design = Design(yearly_order=0)
    fitted = decomposable.fit(train, ["k"], design).where("k = 'a'")
    models = selection.decomposable_rows(fitted, ["k"]).unionByName(
        selection.cell_mean_rows(cell_mean.fit(train, ["k"]), ["k"])
    )
    requests = spark.createDataFrame([("a", 3), ("b", 2), ("zz", 5)], "k string, steps int")
    got = selection.batch_score(requests, models, ["k"], design)
    counts = {(r["k"], r["model_type"], r["status"]): r["n"] for r in got.groupBy("k", "model_type", "status").agg(F.count("*").alias("n")).collect()}
    assert counts == {("a", "decomposable", "ok"): 3, ("b", "cell_mean", "ok"): 2, ("zz", None, "unknown series"): 1}
    direct = decomposable.score(test, fitted, ["k"], design).select("k", "ds", F.col("yhat").alias("direct"))
    gap = got.join(direct, ["k", "ds"]).agg(F.max(F.abs(F.col("yhat") - F.col("direct")))).first()[0]
    assert gap < 1e-9


def test_two_step_model_predicts_the_sale_days(spark):
    rows = [("s", D0 + dt.timedelta(days=t), 50.0 if t % 7 == 5 else 0.0) for t in range(200)]
    df = spark.createDataFrame(rows, "k string, ds date, y double").withColumn("dow", F.weekday("ds"))
    train, test = split(df)
    out = forests.two_step_forecast(train, test, ["k"], ["dow"], trees=10)
    assert out.count() == 28
    sales = {r["dow"]: r["yhat"] for r in out.collect()}
    assert sales[5] == pytest.approx(50, rel=0.2) and all(sales[d] == 0 for d in range(7) if d != 5)


def test_segments_of_two_far_groups(spark):
    rows = [(f"k{i}", float(i % 5) + (1000 if i >= 5 else 0), 1.0) for i in range(10)]
    df = spark.createDataFrame(rows, "k string, x double, constant double")
    labelled = segments.segment(df, ["x", "constant"], 2)
    got = {r["k"]: r["cluster"] for r in labelled.collect()}
    assert all(got[f"k{i}"] == (i >= 5) for i in range(10))
    assert segments.silhouette(labelled, ["x", "constant"]).first()[0] > 0.9
    costs = [r["inertia"] for r in segments.elbow(df, ["x"], range(1, 5)).orderBy("k").collect()]
    assert all(a >= b - 1e-9 for a, b in zip(costs, costs[1:])) and costs[0] == pytest.approx(10)


def test_layouts_of_multi_step_forecasts(spark):
    long = spark.createDataFrame(
        [("s", D0 + dt.timedelta(days=o), s, D0 + dt.timedelta(days=o + s), float(10 * o + s)) for o in range(3) for s in (1, 2)],
        "k string, origin date, step int, ds date, yhat double",
    )
    target = {r["ds"]: (r["yhat1"], r["yhat2"]) for r in collecting.by_target(long, ["k"], 2).collect()}
    assert target[D0 + dt.timedelta(days=2)] == (11.0, 2.0)
    assert target[D0 + dt.timedelta(days=4)] == (None, 22.0)
    origin = {r["ds"]: (r["step0"], r["step1"]) for r in collecting.by_origin(long, ["k"], 2).collect()}
    assert origin[D0 + dt.timedelta(days=1)] == (1.0, 2.0)
    assert {r["yhat"] for r in collecting.latest(long, ["k"]).collect()} == {21.0, 22.0}


def test_day_ahead_reports_uncovered_requests(spark):
    wide = spark.sql("select 'a' as k, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id) as ds, double(id) as yhat1, double(id) + 0.5 as yhat2 from range(5)")
    asks = spark.sql("select 'a' as k, timestamp_ntz'2024-01-01 01:00:00' as start union all select 'a', timestamp_ntz'2024-01-01 04:00:00'")
    got = sorted((str(r["start"]), r["step"], r["yhat"], r["complete"]) for r in collecting.day_ahead(wide, asks, ["k"], 2).collect() if r["complete"])
    assert [(s, v) for _, s, v, _ in got] == [(1, 2.0), (2, 3.5)]


def test_whole_run(spark):
    df = planted(spark, keys=("a", "b")).select("k", F.col("ds").alias("date"), F.round("y").cast("bigint").alias("sales"))
    empty = spark.createDataFrame([("zero", D0 + dt.timedelta(days=i), int(i == 0)) for i in range(0, 100)], "k string, date date, sales bigint")
    result = forecast_run.run(df.unionByName(empty), ["k"], design=Design(yearly_order=0))
    assert result.forecasts.count() == 56
    assert {(r["k"], r["status"]) for r in result.status.collect()} == {("a", "ok"), ("b", "ok"), ("zero", "no model")}
    detail = result.forecasts.agg(F.sum("forecast_sales")).first()[0]
    assert result.rollup("store").agg(F.sum("forecast_sales")).first()[0] == pytest.approx(detail)
    assert result.metrics.count() == 2 and set(result.metrics.columns) >= {"mape", "mase", "params"}


def test_top_items_of_every_store(spark):
    rows = [(s, f"i{i}", D0, 10 * i) for s in ("s1", "s2") for i in range(5)]
    df = spark.createDataFrame(rows, "store string, item string, date date, sales int")
    kept = forecast_run.top_series(df, "store", "item", 2)
    assert {(r["store"], r["item"]) for r in kept.collect()} == {(s, i) for s in ("s1", "s2") for i in ("i3", "i4")}


def test_cell_means_count_empty_days_by_the_calendar(spark):
    days = {"a": (0, 3, 9, 40, 200, 357, 358, 359, 400, 700), "b": (330, 361, 720), "c": (5, 20), "d": (0, 28)}
    rows = [(k, dt.date(2000, 1, 1) + dt.timedelta(n), float(n % 5)) for k, ns in days.items() for n in ns]
    sold = series.daily_totals(spark.createDataFrame(rows, "k string, date date, sales double"), ["k"])
    marked = sold.withColumn("_until", F.date_sub(series.last_day(["k"]), 28)).where("ds <= _until")
    found = cell_mean.fit(with_calendar_flags(marked), ["k"], until="_until").orderBy("k").collect()
    dense = series.daily_series(sold, ["k"], date="ds", value="y")
    back = F.datediff(series.last_day(["k"]), F.col("ds"))
    every_day = dense.withColumn("back", back)
    expected = cell_mean.fit(every_day.where("back >= 28").drop("back"), ["k"]).orderBy("k").collect()
    assert found == expected and [r["k"] for r in found] == ["a", "b", "d"]
    tail = series.daily_series(sold, ["k"], date="ds", value="y", tail=28)
    assert sorted(tail.collect()) == sorted(every_day.where("back < 28").drop("back").collect())


def test_store_forecasts_are_made_without_sorting_filled_days(spark, small):
    from tillcast.plans import catalog

    text = catalog.run("agg_forecast_rollup_department", spark, small)._jdf.queryExecution().sparkPlan().toString()
    assert "Generate" in text and "Window" in text
    # Rows come in depth-first order: no window stands over the filled days.
    assert text.rindex("Window") > text.index("Generate") > 0 and "Window" not in text[: text.index("Generate")]
