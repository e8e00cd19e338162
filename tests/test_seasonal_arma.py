"""Seasonal ARIMA by Hannan-Rissanen: planted coefficients, orders, differences and short series."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.functions.dates import with_calendar_flags
from tillcast.operators import normal_equations as ne
from tillcast.operators import seasonal_arma
from tillcast.operators.recursion import extended

D0 = dt.date(2015, 1, 5)


def frame(spark, series, test_days=14):
    rows = []
    for key, values in series.items():
        for t, v in enumerate(values):
            rows.append((key, D0 + dt.timedelta(days=t), float(v), "train"))
        for t in range(len(values), len(values) + test_days):
            rows.append((key, D0 + dt.timedelta(days=t), None, "test"))
    df = spark.createDataFrame(rows, "k string, ds date, y double, split string").repartition(5)
    return with_calendar_flags(df)


def arma(rng, n, phi=(), theta=(), seasonal_theta=0.0, m=7, level=50.0):
    e = rng.normal(size=n + 50)
    w = np.zeros(n + 50)
    for t in range(10, n + 50):
        w[t] = e[t] + sum(a * w[t - k] for k, a in enumerate(phi, 1)) + sum(b * e[t - k] for k, b in enumerate(theta, 1))
        w[t] += seasonal_theta * e[t - m]
    return w[50:] + level


def test_planted_coefficients_are_found(spark):
    rng = np.random.default_rng(3)
    planted = {f"s{i}": arma(rng, 4000, phi=(0.6,), theta=(0.5,)) for i in range(3)}
    df = frame(spark, planted).withColumns({"d": F.lit(0), "seasonal_d": F.lit(0)})
    models, *_ = seasonal_arma._fit(df, ["k"], [], ((1, 1, 0, 0),), 7, 21)
    for r in models.collect():
        _, phi, theta = r.coefficients
        assert phi == pytest.approx(0.6, rel=0.1) and theta == pytest.approx(0.5, rel=0.1)
    assert models.count() == 3


def test_seasonal_moving_average_is_found(spark):
    rng = np.random.default_rng(4)
    df = frame(spark, {"a": arma(rng, 4000, seasonal_theta=0.6)})
    df = df.withColumns({"d": F.lit(0), "seasonal_d": F.lit(0)})
    models, _, w_lags, e_lags = seasonal_arma._fit(df, ["k"], [], ((0, 0, 0, 1),), 7, 28)
    assert (w_lags, e_lags) == ([], [7])
    assert models.first().coefficients[1] == pytest.approx(0.6, rel=0.1)


def test_differences_and_orders_follow_the_data(spark):
    rng = np.random.default_rng(5)
    n = 1200
    week = 30 * np.sin(2 * np.pi * np.arange(n) / 7)
    series = {
        "noise": arma(rng, n),
        "walk": 500 + np.cumsum(rng.normal(size=n)),
        "week": 100 + week + rng.normal(size=n),
        "ar": arma(rng, n, phi=(0.7,)),
        "constant": np.full(n, 5.0),
    }
    df = frame(spark, series)
    found = {r.k: (r.d, r.seasonal_d) for r in seasonal_arma.differencing(df.where("split = 'train'"), ["k"]).collect()}
    assert found["noise"] == found["ar"] == (0, 0)
    assert found["walk"] == (1, 0)
    assert found["week"] == (0, 1)
    forecasts = seasonal_arma.forecast(df, ["k"], regressors=[])
    rows = forecasts.collect()
    assert len(rows) == 5 * 14 and {r.status for r in rows} == {"ok"}
    order = {r.k: tuple(r.order) for r in rows}
    assert order["ar"][0] >= 1 or order["ar"][2] >= 1
    assert len(set(order.values())) >= 3
    by = {(r.k, r.ds): r.yhat for r in rows}
    for t in range(14):
        day = D0 + dt.timedelta(days=n + t)
        truth = 100 + 30 * np.sin(2 * np.pi * (n + t) / 7)
        assert by["week", day] == pytest.approx(truth, abs=6)
        assert by["noise", day] == pytest.approx(50, abs=1)
        assert by["constant", day] == pytest.approx(5, abs=0.1)


def test_short_series_get_the_fixed_order_or_none(spark):
    rng = np.random.default_rng(6)
    week = 20 + 5 * np.sin(2 * np.pi * np.arange(45) / 7)
    df = frame(spark, {"long": arma(rng, 400), "short": week + rng.normal(size=45) / 10, "tiny": week[:9]})
    rows = seasonal_arma.forecast(df, ["k"], regressors=[]).collect()
    status = {r.k: r.status for r in rows}
    assert status == {"long": "ok", "short": "fixed order", "tiny": "too short"}
    assert {tuple(r.order) for r in rows if r.k == "short"} == {(1, 1, 1, 1, 1, 1, 7)}
    assert all(np.isnan(r.yhat) for r in rows if r.k == "tiny")
    assert len(rows) == 3 * 14


def test_sums_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(ne, "_HELD_GROUPS", 2)
    rng = np.random.default_rng(7)
    data = [(f"k{i % 5}", *map(float, rng.normal(size=3))) for i in range(200)] + [("k0", None, 1.0, 1.0)]
    got = []
    for parts in (1, 6):
        df = spark.createDataFrame(data, "k string, a double, b double, y double").repartition(parts)
        sums = ne.product_sums(df, ["k"], [F.lit(1.0), F.col("a"), F.col("b")], F.col("y")).orderBy("k").collect()
        assert [r.n for r in sums] == [40] * 5
        got.append([r.gram + r.rhs + [r.yy] for r in sums])
    assert np.allclose(*got)
    x = np.array([(1.0, a, b) for k, a, b, y in data if k == "k1"])
    y = np.array([y for k, a, b, y in data if k == "k1"])
    beta = ne.coefficients(ne.product_sums(df, ["k"], [F.lit(1.0), F.col("a"), F.col("b")], F.col("y")), ["k"])
    assert np.allclose(beta.where("k = 'k1'").first().coefficients, np.linalg.lstsq(x, y, rcond=None)[0])


@pytest.mark.parametrize("d,seasonal_d", [(0, 0), (1, 0), (0, 1), (1, 1)])
def test_levels_follow_from_differences(spark, d, seasonal_d):
    rng = np.random.default_rng(8)
    y = rng.normal(size=40).tolist()
    w = [y[t] - d * y[t - 1] - seasonal_d * y[t - 3] + d * seasonal_d * y[t - 4] for t in range(4, 40)]
    e, drives = rng.normal(size=5).tolist(), rng.normal(size=6).tolist()
    df = spark.createDataFrame([(w[-5:], e, y[-4:], drives)], "w array<double>, e array<double>, y array<double>, u array<double>")
    got = df.select(
        extended(
            F.col("u"), F.col("w"), {1: F.lit(0.5), 3: F.lit(-0.2)}, F.col("e"), {2: F.lit(0.3)},
            F.col("y"), F.lit(d), F.lit(seasonal_d), 3,
        )
    ).first()[0]
    ys, ws, es = list(y), list(w), list(e)
    for u in drives:
        step = u + 0.5 * ws[-1] - 0.2 * ws[-3] + 0.3 * es[-2]
        ws.append(step)
        es.append(0.0)
        ys.append(step + d * ys[-1] + seasonal_d * ys[-3] - d * seasonal_d * ys[-4])
    assert got == pytest.approx(ys[40:])
