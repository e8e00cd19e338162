"""Augmented unit-root test and simulated trend intervals."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_fitted_models import daily, split
from tillcast.operators import decomposable, stats, trend_uncertainty, unit_root
from tillcast.operators.decomposable import Config, Design


def test_no_lags_equal_the_plain_test(spark):
    rng = np.random.default_rng(1)
    data = {"noise": rng.normal(size=300), "walk": np.cumsum(rng.normal(size=300)), "flat": np.full(50, 3.0), "two": [1.0, 2.0]}
    df = daily(spark, data)
    plain = {r.k: r.df_statistic for r in stats.stationarity(df, ["k"]).collect()}
    found = {r.k: r for r in unit_root.augmented(df, ["k"], fixed=0).collect()}
    for k in ("noise", "walk"):
        assert found[k].adf_statistic == pytest.approx(plain[k], rel=1e-6)
    assert (found["noise"].suggested_d, found["walk"].suggested_d) == (0, 1)
    for k in ("flat", "two"):
        assert found[k].adf_statistic is None and found[k].p_value is None and found[k].suggested_d == 1


def test_lags_follow_the_data(spark):
    rng = np.random.default_rng(2)
    n = 2000
    step = np.zeros(n)
    for t in range(3, n):
        step[t] = 0.5 * step[t - 1] + 0.3 * step[t - 3] + rng.normal()
    data = {"lagged": np.cumsum(step), "plain": np.cumsum(rng.normal(size=n))}
    found = {r.k: r for r in unit_root.augmented(daily(spark, data), ["k"]).collect()}
    assert found["lagged"].lags >= 3 and found["lagged"].suggested_d == 1
    assert found["plain"].lags <= 3 and found["plain"].suggested_d == 1


def test_published_p_values():
    # Critical values of the test with a constant, long series.
    for t, p in ((-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)):
        assert unit_root.p_value(t) == pytest.approx(p, abs=0.002)
    values = [unit_root.p_value(t) for t in np.linspace(-20, 4, 200)]
    assert values == sorted(values) and values[0] == 0.0 and values[-1] == 1.0


DESIGN = Design(changepoints=5, yearly_order=0, weekly_order=0, regressors=())


def bands(spark, data, partitions=4, design=DESIGN, level=0.8):
    train, test = split(daily(spark, data, partitions), 28)
    models = decomposable.fit(train, ["k"], design, Config(changepoint_prior_scale=10.0))
    fitted = decomposable.score(train, models, ["k"], design, clamp=False)
    ahead = decomposable.score(test, models, ["k"], design, clamp=False)
    spread = trend_uncertainty.residual_spread(fitted, ["k"])
    draws = trend_uncertainty.simulated(ahead.drop("trend"), models, spread, ["k"], design)
    return trend_uncertainty.band(draws, ["k"], level), test


def test_intervals_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(3)
    data = {k: 50 + np.cumsum(rng.normal(size=200)) for k in "ab"}
    got = []
    for parts in (1, 9):
        found, _ = bands(spark, data, parts)
        got.append(sorted((r.k, r.ds, round(r.yhat_lower, 6), round(r.yhat_upper, 6)) for r in found.collect()))
    assert got[0] == got[1] and len(got[0]) == 2 * 28


def test_intervals_widen_with_the_horizon_where_the_trend_changes(spark):
    # The slope turns around at every changepoint of the 371 training days.
    rng = np.random.default_rng(4)
    turns = [0.8 * j / 6 * 371 for j in range(1, 6)]
    slopes = [0.5 * (-1) ** sum(t >= c for c in turns) for t in range(400)]
    bent = 100 + np.cumsum(slopes) + rng.normal(size=400) / 2
    found, _ = bands(spark, {"bent": bent})
    widths = [r.yhat_upper - r.yhat_lower for r in found.orderBy("ds").collect()]
    assert np.mean(widths[-5:]) > 1.5 * np.mean(widths[:3])


def test_planted_coverage(spark):
    rng = np.random.default_rng(5)
    data = {f"s{i:03}": 100 + 3 * rng.normal(size=328) for i in range(200)}
    line = Design(changepoints=0, yearly_order=0, weekly_order=0, regressors=())
    found, test = bands(spark, data, design=line)
    inside = found.join(test.select("k", "ds", "y"), ["k", "ds"]).select(
        F.avg(F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper")).cast("double"))
    )
    assert inside.first()[0] == pytest.approx(0.8, abs=0.02)
