"""Sparse trend changes, partial pooling, mixed terms, events and conditional seasons."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_fitted_models import D0, daily, split
from tillcast.operators import decomposable, joins, mixed_terms, partial_pooling, sparse_trend
from tillcast.operators.decomposable import Config, Design


def test_planted_break_is_found_and_the_rest_is_zero(spark):
    t = np.arange(1101)
    rng = np.random.default_rng(1)
    # A change lies at share 0.8 * 5 / 11 of the span.
    at = 0.8 * 5 / 11 * 1100
    data = {
        "break": 50 + 0.02 * t + 0.1 * np.maximum(t - at, 0) + 0.2 * rng.normal(size=1101),
        "line": 50 + 0.02 * t + 0.2 * rng.normal(size=1101),
    }
    design = Design(changepoints=10, yearly_order=0, weekly_order=1, regressors=())
    train = daily(spark, data)
    models = sparse_trend.fit(train, ["k"], design, Config(changepoint_prior_scale=0.5))
    found = {r.k: r for r in models.collect()}
    assert all(r.violation < 1e-6 for r in found.values())
    assert found["line"].changes == 0 and 1 <= found["break"].changes <= 3
    changes = sparse_trend.trend_changes(models, ["k"], design).collect()
    assert {r.k for r in changes} == {"break"}
    largest = max(changes, key=lambda r: abs(r.effect))
    assert abs((largest.ds - D0).days - at) <= 1
    assert sum(r.effect for r in changes) == pytest.approx(0.1, rel=0.1)
    dense = {r.k: r for r in sparse_trend.fit(train, ["k"], design, Config(changepoint_prior_scale=1e6)).collect()}
    assert all(r.changes == 10 for r in dense.values())


def test_descent_reaches_the_optimum():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3, 50, 6))
    y = x @ np.array([2.0, 0, 0, -1.0, 0, 0]) + 0.1 * rng.normal(size=(3, 50))
    gram, rhs = np.einsum("sni,snj->sij", x, x), np.einsum("sni,sn->si", x, y)
    beta = sparse_trend.descended(gram, rhs, 5.0)
    assert sparse_trend.violation(gram, rhs, beta, np.ones(6, bool), 5.0).max() < 1e-7
    assert (beta == 0).any()
    assert np.allclose(sparse_trend.descended(gram, rhs, 0.0), np.linalg.solve(gram, rhs[..., None])[..., 0])


def pooled_data(rng, series=12, days=200):
    t = np.arange(days)
    return {
        f"s{i:02}": 20 + 3 * np.sin(2 * np.pi * t / 7 + 0.3) + rng.normal(scale=1 + 3 * (i % 3), size=days if i else days)
        for i in range(series)
    }


def test_pooling_lies_between_local_and_global(spark):
    rng = np.random.default_rng(3)
    data = pooled_data(rng)
    data["short"] = data["s00"][:30] + 5 * rng.normal(size=30)
    train = daily(spark, data)
    design = Design(changepoints=1, yearly_order=0, weekly_order=2, regressors=("is_weekend",))
    by = lambda models: {r.k: np.array(r.coefficients) for r in models.collect()}
    local = by(decomposable.fit(train, ["k"], design))
    shared = by(decomposable.fit(train, ["k"], design, scope="global"))
    none = by(partial_pooling.fit(train, ["k"], design, between=0.0))
    free = by(partial_pooling.fit(train, ["k"], design, between=math.inf))
    drawn = by(partial_pooling.fit(train, ["k"], design))
    for k in data:
        assert np.allclose(none[k], shared[k], atol=1e-6)
        assert np.allclose(free[k], local[k], atol=1e-7)
    distance = lambda models, k: float(np.linalg.norm(models[k] - shared[k]))
    assert distance(drawn, "short") < 0.7 * distance(local, "short")
    assert sum(distance(drawn, k) for k in data) < sum(distance(local, k) for k in data)


def test_pooling_of_one_series(spark):
    train = daily(spark, {"a": np.arange(50.0)})
    design = Design(changepoints=0, yearly_order=0, weekly_order=0, regressors=())
    models = partial_pooling.fit(train, ["k"], design).collect()
    assert len(models) == 1
    scored = decomposable.score(train, partial_pooling.fit(train, ["k"], design), ["k"], design, clamp=False)
    assert scored.agg(F.max(F.abs(F.col("y") - F.col("yhat")))).first()[0] < 1e-3


def test_mixed_terms_are_recovered_and_the_loss_never_rises(spark):
    t = np.arange(730)
    rng = np.random.default_rng(4)
    trend = 100 + 0.2 * t
    push = rng.integers(0, 2, 730)
    boost = rng.integers(0, 2, 730)
    y = trend * (1 + 0.1 * np.sin(2 * np.pi * (t + (D0 - dt.date(1970, 1, 1)).days) / 7) + 0.3 * boost) + 25 * push
    df = daily(spark, {"a": y}, push={"a": push}, boost={"a": boost})
    train, test = split(df, 28)
    design = Design(changepoints=0, yearly_order=0, weekly_order=1, regressors=("push", "boost"))
    kinds = {"weekly", "boost"}
    models = mixed_terms.fit(train, ["k"], design, kinds)
    row = models.first()
    assert all(b <= a + 1e-12 for a, b in zip(row.losses, row.losses[1:]))
    assert row.coefficients[2] == pytest.approx(0.1, abs=0.003)
    assert row.coefficients[4] * row.cap == pytest.approx(25, rel=0.03)
    assert row.coefficients[5] == pytest.approx(0.3, abs=0.01)
    for r in mixed_terms.score(test, models, ["k"], design, kinds).collect():
        assert r.yhat == pytest.approx(r.y, rel=0.01)
        assert r.yhat == pytest.approx(r.trend * (1 + r.multiplicative) + r.additive)
    with pytest.raises(ValueError):
        mixed_terms.multiplicative_columns(design, {"trend"})
    with pytest.raises(ValueError):
        mixed_terms.multiplicative_columns(design, {"nothing"})


def test_only_additive_terms_equal_the_plain_fit(spark):
    train, _ = split(daily(spark, {"a": 30 + np.sin(np.arange(300)), "zero": np.zeros(300)}))
    design = Design(changepoints=2, yearly_order=0, weekly_order=2)
    plain = {r.k: r.coefficients for r in decomposable.fit(train, ["k"], design).collect()}
    for r in mixed_terms.fit(train, ["k"], design, set()).collect():
        assert np.allclose(r.coefficients, plain[r.k], atol=1e-9)


def test_planted_events_and_conditional_weeks(spark):
    t = np.arange(600)
    days = [D0 + dt.timedelta(days=int(i)) for i in t]
    feast = [days[40], days[200], days[310], days[420], days[560], days[590]]
    events = spark.createDataFrame([("feast", d, -1, 1) for d in feast], "event string, ds date, lower_window int, upper_window int")
    near = np.array([any(abs((d - f).days) <= 1 for f in feast) for d in days])
    summer = np.array([d.month in (6, 7, 8) for d in days])
    wave = np.sin(2 * np.pi * (t + (D0 - dt.date(1970, 1, 1)).days) / 7)
    y = 100 + 40 * near + np.where(summer, 12, 3) * wave
    df = joins.event_flags(daily(spark, {"a": y}), events, ["feast"])
    df = df.withColumns({"summer": F.month("ds").isin(6, 7, 8).cast("int")}).withColumn("rest", 1 - F.col("summer"))
    train, test = split(df, 28)
    design = Design(
        changepoints=0, yearly_order=0, weekly_order=0, regressors=("feast",),
        conditional_seasons=((7.0, 2, "summer"), (7.0, 2, "rest")),
    )
    models = decomposable.fit(train, ["k"], design)
    row = models.first()
    names = list(design.groups())
    assert names == ["trend", "conditional", "regressors"]
    c = np.array(row.coefficients) * row.cap
    assert c[2] == pytest.approx(12, rel=0.02) and c[6] == pytest.approx(3, rel=0.05)
    assert c[10] == pytest.approx(40, rel=0.02)
    found = decomposable.score(test, models, ["k"], design, clamp=False).collect()
    assert max(abs(r.y - r.yhat) for r in found) < 0.5
    assert sum(r.feast for r in found) > 0
