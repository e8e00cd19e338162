"""Series as one row each: the same series, models and forecasts as from rows of days, without exchanging days."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.functions.dates import with_calendar_flags
from tillcast.operators import decomposable, seasonal_arma, series, whole_series
from tillcast.operators.decomposable import Design
from tillcast.plans import forecast_run

D0 = dt.date(2015, 6, 1)
SCHEMA = "k string, date date, sales bigint"


def daily(spark):
    """Sparse and full series, outliers at an end and inside, days that come twice or without a date."""
    rng = np.random.default_rng(11)
    rows = []
    for key, days, share in (("a", 700, 0.4), ("b", 500, 1.0), ("c", 90, 0.7), ("d", 64, 0.9), ("short", 30, 1.0), ("tiny", 12, 1.0), ("empty", 200, 0.05)):
        values = rng.integers(5, 20, days) + 4 * (np.arange(days) % 7 == 5)
        rows += [(key, i, int(v)) for i, v in enumerate(values) if i in (0, days - 1) or rng.random() < share]
    rows += [("a", 0, 900), ("b", 250, 800), ("b", 499, 700), ("c", 4, 3), ("c", 4, 2), ("d", 20, None), ("same", 0, 4), ("same", 1, 4)]
    rows += [(None, i, 5) for i in range(100)]
    listed = [(k, D0 + dt.timedelta(days=i), v) for k, i, v in rows]
    return spark.createDataFrame([*listed, ("a", None, 7), ("undated", None, 3)], SCHEMA).repartition(3)


def by_days(df):
    dense = series.daily_series(df.where("date is not null"), ["k"], flags=False)
    kept = series.drop_z_outliers(series.drop_mostly_zero(dense, ["k"]), ["k"])
    return series.refill(kept, ["k"])


def test_cleaned_series_are_those_of_the_single_days(spark):
    every = forecast_run.clean_series(daily(spark), ["k"])
    found = {r.k: r.kept for r in every.collect()}
    assert len(found) == every.count() == 10  # one row for each series, those without a model included
    assert {k for k, kept in found.items() if not kept} == {None, "empty", "undated"}
    expected = {(r.k, r.ds): r.y for r in by_days(daily(spark)).where("k is not null").collect()}
    kept = every.where("kept")
    got = whole_series.last_days(kept, ["k"], 10_000).select("k", "ds", "y").collect()
    assert len(got) == len(expected) and {(r.k, r.ds): r.y for r in got} == expected
    sold = {(r.k, r.ds): r.y for r in whole_series.sold_days(kept, ["k"]).collect()}
    assert {k: v for k, v in sold.items() if v} == {k: v for k, v in expected.items() if v}


def test_tuned_models_are_those_of_the_single_days(spark):
    design = Design(yearly_order=1)
    kept = forecast_run.clean_series(daily(spark), ["k"]).where("kept")
    split = series.split_tail_days(by_days(daily(spark)).where("k is not null"), ["k"], 28).where("split = 'train'")
    expected = {r.k: r for r in decomposable.fit_tuned(split, ["k"], design).collect()}
    whole = decomposable.fit_tuned_whole(whole_series.upto(kept, F.col("last") - 28), ["k"], design)
    found = {r.k: r for r in whole.collect()}
    assert set(found) == set(expected) == {"a", "b", "c", "d"}
    for key, row in found.items():
        want = expected[key]
        assert (row.t0, row.span, row.cap, row.last_date, row.params) == (want.t0, want.span, want.cap, want.last_date, want.params)
        assert row.coefficients == pytest.approx(want.coefficients, rel=1e-5, abs=1e-5)


def test_seasonal_forecasts_are_those_of_the_single_days(spark):
    kept = forecast_run.clean_series(daily(spark), ["k"]).where("kept")
    marked = kept.withColumn("actual", whole_series.tail(14))
    train = whole_series.upto(marked, F.col("last") - 14)
    whole = seasonal_arma.forecast_whole(train, ["k"], 14, actual="actual")
    above = whole._jdf.queryExecution().executedPlan().toString().split("MapInPandas")[:2]
    assert not any("Exchange" in part for part in above)  # only the cleaning, below both, has one
    found = {(r.k, r.ds): r for r in whole.collect()}
    split = series.split_tail_days(by_days(daily(spark)).where("k is not null"), ["k"], 14)
    long = split.where("k in ('a', 'b', 'c', 'd', 'short')")
    expected = seasonal_arma.forecast(long, ["k"]).join(long.select("k", "ds", "y"), ["k", "ds"]).collect()
    assert len(found) == len(expected) == 5 * 14
    for want in expected:
        row = found[want.k, want.ds]
        assert (row.status, row.order, row.y) == (want.status, want.order, want.y)
        assert row.yhat == pytest.approx(want.yhat, rel=1e-5, abs=1e-5, nan_ok=True)
    assert {r.status for r in found.values()} == {"ok", "fixed order", "too short"}


def test_flags_of_tasks_are_those_of_columns(spark):
    days = np.arange(-800, 20_000, 37)
    frame = with_calendar_flags(spark.createDataFrame([(int(d),) for d in days], "day int").withColumn("ds", whole_series.as_date(F.col("day"))))
    rows = frame.orderBy("day").collect()
    for name, values in whole_series.flags(days).items():
        assert [r[name] for r in rows] == [int(v) for v in values]


def test_store_run_exchanges_no_filled_days(spark, monkeypatch):
    written = []

    def keep(df, name, *_):
        written.append((name, df.cache().count()))
        return df

    monkeypatch.setattr(forecast_run, "materialise", keep)
    days = [("a", D0 + dt.timedelta(days=2 * i), 5 + i % 3) for i in range(100)]
    result = forecast_run.run(spark.createDataFrame(days, SCHEMA), ["k"], design=Design(yearly_order=0))
    assert result.forecasts.count() == 28
    assert dict(written)["series"] == 1 and dict(written)["forecasts"] == 3 * 28
