"""Lags, folds from block sums, quantile regression and saturating growth on planted series."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.functions.dates import with_calendar_flags
from tillcast.operators import decomposable, quantile_fit, saturating, series
from tillcast.operators.decomposable import Config, Design

D0 = dt.date(2016, 1, 4)
PLAIN = Design(changepoints=0, yearly_order=0, weekly_order=0, regressors=())


def daily(spark, data, partitions=4, **more):
    rows = [
        (k, D0 + dt.timedelta(days=t), float(v), *[float(more[c][k][t]) for c in more])
        for k, values in data.items()
        for t, v in enumerate(values)
    ]
    columns = "".join(f", {c} double" for c in more)
    df = spark.createDataFrame(rows, f"k string, ds date, y double{columns}").repartition(partitions)
    return with_calendar_flags(df)


def split(df, days=10):
    marked = series.split_tail_days(df, ["k"], days)
    return marked.where("split = 'train'").drop("split"), marked.where("split = 'test'").drop("split")


def test_lags_are_found_and_followed(spark):
    rng = np.random.default_rng(1)
    n, data, push = 600, {}, {}
    for k in "ab":
        x, y = rng.normal(size=n), np.zeros(n)
        for t in range(2, n):
            y[t] = 0.5 * y[t - 1] - 0.3 * y[t - 2] + 2.0 * x[t - 1] + 0.01 * rng.normal()
        data[k], push[k] = y + 10, x
    train, test = split(daily(spark, data, push=push))
    design = Design(0, 0, 0, (), (), lags=2, lagged_regressors=(("push", 1),))
    models = decomposable.fit_lagged(train, ["k"], design)
    for r in models.collect():
        cap = r.cap
        assert r.coefficients[2] * cap == pytest.approx(2.0, abs=0.02)
        assert r.coefficients[3:] == pytest.approx([0.5, -0.3], abs=0.01)
    found = decomposable.score_recursive(train, test, models, ["k"], design).orderBy("k", "ds").collect()
    assert len(found) == 20
    m = {r.k: r for r in models.collect()}
    for k in "ab":
        c, cap = m[k].coefficients, m[k].cap
        ys, last = list(data[k][: n - 10]), push[k][n - 11]
        for h, r in enumerate([r for r in found if r.k == k]):
            t = (D0 + dt.timedelta(days=n - 10 + h) - m[k].t0).days / m[k].span
            step = cap * (c[0] + c[1] * t + c[2] * last) + c[3] * ys[-1] + c[4] * ys[-2]
            ys.append(step)
            assert r.ds == D0 + dt.timedelta(days=n - 10 + h)
            assert r.yhat == pytest.approx(step, abs=1e-9)


def test_lags_with_seasons_and_short_series(spark):
    t = np.arange(300)
    data = {"a": 20 + 5 * np.sin(2 * np.pi * t / 7), "b": np.full(300, 4.0), "c": np.arange(12.0)}
    train, test = split(daily(spark, data))
    design = Design(changepoints=0, yearly_order=0, weekly_order=3, regressors=("is_weekend",), lags=3)
    models = decomposable.fit_lagged(train, ["k"], design)
    found = decomposable.score_recursive(train, test, models, ["k"], design).collect()
    assert {r.k for r in found} == {"a", "b"}  # two days are fewer than three lags
    for r in found:
        if r.k == "a":
            truth = 20 + 5 * math.sin(2 * math.pi * (r.ds - D0).days / 7)
            assert r.yhat == pytest.approx(truth, abs=0.05)
        else:
            assert r.yhat == pytest.approx(4.0, abs=1e-6)


def test_folds_from_blocks_equal_separate_fits(spark):
    rng = np.random.default_rng(2)
    n = {"a": 400, "b": 137, "c": 60, "d": 3}
    data = {k: 10 + 0.05 * np.arange(m) + 3 * np.sin(np.arange(m) / 7 * 2 * np.pi) + rng.normal(size=m) for k, m in n.items()}
    df = daily(spark, data)
    design = Design(changepoints=4, yearly_order=1, weekly_order=2)
    found = decomposable.cross_validate(df, ["k"], design, k=5).collect()
    got = {(r.k, r.fold, r.ds): r.yhat for r in found}
    folds = series.folds_expanding(df, ["k"], 5)
    assert set(got) == {(r.k, r.fold, r.ds) for r in folds.where("split = 'test'").collect()}
    assert len(got) == len(found)
    framed = decomposable.training_frame(df, ["k"])
    scale = framed.select("k", "ds", "t0", "span", "cap")
    keys = ["k", "fold"]
    train = folds.where("split = 'train'").join(scale, ["k", "ds"])
    sums = decomposable.column_products(train, keys, design)
    models = decomposable.solve(sums, keys, design, [Config()]).select(*keys, "mode", "coefficients")
    test = folds.where("split = 'test'").join(scale, ["k", "ds"]).join(models, keys)
    for r in decomposable.score(test, None, keys, design, clamp=False).collect():
        assert got[r.k, r.fold, r.ds] == pytest.approx(r.yhat, abs=1e-9)


def test_quantiles_hold_their_shares_and_do_not_cross(spark):
    rng = np.random.default_rng(3)
    t = np.arange(1000)
    base = 100 + 0.02 * t + 10 * np.sin(2 * np.pi * t / 7)
    data = {"even": base + rng.uniform(-20, 20, 1000), "skew": base + rng.exponential(10, 1000), "flat": np.full(1000, 7.0)}
    df = daily(spark, data)
    design, probs = Design(changepoints=2, yearly_order=0), {"lower": 0.1, "median": 0.5, "upper": 0.9}
    models = quantile_fit.fit(df, ["k"], design, probs)
    scored = quantile_fit.score(df, models, ["k"], design, probs)
    shares = scored.groupBy("k").agg(
        *[F.avg((F.col("y") <= F.col(n) + 1e-9).cast("double")).alias(n) for n in probs],
        F.max((F.col("lower") > F.col("median")).cast("int") + (F.col("median") > F.col("upper")).cast("int")).alias("crossed"),
    )
    for r in shares.collect():
        assert r.crossed == 0
        if r.k != "flat":
            assert [r.lower, r.median, r.upper] == pytest.approx([0.1, 0.5, 0.9], abs=0.01)
    # The planted quantiles of the even noise are 16 above and below.
    even = scored.where("k = 'even'").select(F.avg(F.col("upper") - F.col("lower"))).first()[0]
    assert even == pytest.approx(32, abs=2)
    for r in models.collect():
        assert all(r.converged) and all(0 < n <= quantile_fit.MOST_ROUNDS for n in r.rounds)


def test_reweighting_finds_the_least_loss():
    rng = np.random.default_rng(4)
    x = np.column_stack([np.ones(200), rng.normal(size=200)])
    y = x @ [1.0, 2.0] + rng.exponential(size=200)
    beta, _, converged, loss = quantile_fit.reweighted(x, y, 0.8, np.zeros(2))
    assert converged
    for shift in rng.normal(scale=0.05, size=(200, 2)):
        assert loss <= quantile_fit._pinball(y - x @ (beta + shift), 0.8) + 1e-4


def test_saturating_growth_is_recovered(spark):
    rng = np.random.default_rng(5)
    t = np.linspace(0, 1, 801)
    planted = {"a": (200.0, 9.0, 0.4), "b": (50.0, 14.0, 0.6), "c": (1000.0, 6.0, 0.5)}
    data = {k: c / (1 + np.exp(-r * (t - m))) + c * 0.01 * rng.normal(size=801) for k, (c, r, m) in planted.items()}
    found = {r.k: r for r in saturating.fit_growth(daily(spark, data), ["k"]).collect()}
    for k, (c, r, m) in planted.items():
        assert found[k].converged
        assert found[k].capacity == pytest.approx(c, rel=0.02)
        assert found[k].rate == pytest.approx(r, rel=0.05)
        assert found[k].midpoint == pytest.approx(m, abs=0.01)


def test_saturating_forecasts_with_a_week(spark):
    t = np.arange(760)
    curve = 300 / (1 + np.exp(-0.02 * (t - 300)))
    data = {"a": curve + 5 * np.sin(2 * np.pi * t / 7), "zero": np.zeros(760), "flat": np.full(760, 9.0)}
    train, test = split(daily(spark, data), 28)
    design = Design(changepoints=3, yearly_order=0)
    for capacity in ("fitted", "largest"):
        models = saturating.fit(train, ["k"], design, capacity=capacity)
        found = saturating.score(test, models, ["k"], design).collect()
        assert len(found) == 3 * 28
        for r in found:
            assert r.yhat == r.yhat and r.yhat >= 0
            if r.k == "flat":
                assert r.yhat == pytest.approx(9, abs=0.2)
            if r.k == "zero":
                assert r.yhat == 0
    models = saturating.fit(train, ["k"], design).where("k = 'a'").first()
    assert models.capacity == pytest.approx(300, rel=0.01)
    assert models.rate / models.span == pytest.approx(0.02, rel=0.05)
    largest = saturating.fit_growth(train, ["k"], "largest").where("k = 'a'").first().capacity
    assert largest == train.where("k = 'a'").agg(F.max("y")).first()[0]
