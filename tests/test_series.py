"""Series preparation, statistics and evaluation on small worked frames."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tillcast.operators import evaluation, intervals, series, stats

D0 = dt.date(2020, 1, 6)  # a Monday


def day(i):
    return D0 + dt.timedelta(days=i)


def frame(spark, ys, key="s"):
    return spark.createDataFrame([(key, day(i), float(y)) for i, y in enumerate(ys) if y is not None], "k string, ds date, y double")


def ys(df):
    return [r["y"] for r in df.orderBy("ds").collect()]


def test_gaps_become_zero_days_with_their_own_flags(spark):
    rows = spark.createDataFrame(
        [("s", day(i), 1) for i in (0, 1, 2, 5, 7, 8, 9)] + [("s", day(9), None)], "k string, date date, sales int"
    )
    dense = series.daily_series(rows, ["k"]).orderBy("ds").collect()
    assert [r["y"] for r in dense] == [1, 1, 1, 0, 0, 1, 0, 1, 1, 1]
    assert [r["day_of_week"] for r in dense] == [0, 1, 2, 3, 4, 5, 6, 0, 1, 2]
    assert [r["is_weekend"] for r in dense][5:8] == [1, 1, 0]
    missing = series.missing_dates(rows.where("sales is not null"), ["k"], "date")
    assert sorted(r["date"] for r in missing.collect()) == [day(3), day(4), day(6)]


def test_weeks_end_on_sunday(spark):
    rows = spark.createDataFrame([("s", day(0), 1), ("s", day(6), 2), ("s", day(21), 4)], "k string, date date, sales int")
    weekly = series.weekly_series(rows, ["k"]).orderBy("ds").collect()
    assert [(r["ds"], r["y"]) for r in weekly] == [(day(6), 3.0), (day(13), 0.0), (day(20), 0.0), (day(27), 4.0)]


def test_zero_ratio_is_strict(spark):
    exact = frame(spark, [0] * 9 + [1], "at")
    above = frame(spark, [0] * 10 + [1], "above")
    kept = series.drop_mostly_zero(exact.unionByName(above), ["k"])
    assert {r["k"] for r in kept.collect()} == {"at"}


def test_outlier_becomes_zero(spark):
    df = frame(spark, [10] * 15 + [1000] + [10] * 14)
    cleaned = series.refill(series.drop_z_outliers(df, ["k"]), ["k"])
    assert ys(cleaned) == [10] * 15 + [0] + [10] * 14
    line = series.refill(series.drop_z_outliers(df, ["k"]), ["k"], mode="interpolate")
    assert ys(line) == [10] * 30
    assert [r["y"] for r in series.iqr_outliers(df, ["k"]).collect()] == [1000.0]


def test_outlier_at_the_edge_shortens_the_series(spark):
    df = frame(spark, [10] * 20 + [1000])
    assert len(ys(series.refill(series.drop_z_outliers(df, ["k"]), ["k"]))) == 20


def test_constant_series_keeps_all_rows(spark):
    assert len(ys(series.drop_z_outliers(frame(spark, [5] * 10), ["k"]))) == 10


def test_short_gaps_are_linear_and_long_ones_averaged(spark):
    df = frame(spark, [2.0, None, 6.0, 10.0] + [None] * 6 + [0.0])
    assert ys(series.impute_gaps(df, ["k"], limit=5)) == [2, 4, 6, 10] + [6] * 6 + [0]


def test_tail_split_and_lengths(spark):
    df = frame(spark, range(40)).unionByName(frame(spark, range(10), "short"))
    split = series.split_tail_days(df, ["k"], 28)
    assert split.where("k = 's' and split = 'test'").count() == 28
    status = {r["k"]: r["status"] for r in series.length_status(df, ["k"], 28).collect()}
    assert status == {"s": "ok", "short": "too short"}


def test_expanding_folds(spark):
    folds = series.folds_expanding(frame(spark, range(12)), ["k"], 3)
    got = {(r["fold"], r["split"]): r["n"] for r in folds.groupBy("fold", "split").agg(F.count("*").alias("n")).collect()}
    assert got == {(1, "train"): 3, (1, "test"): 3, (2, "train"): 6, (2, "test"): 3, (3, "train"): 9, (3, "test"): 3}
    test_rows = folds.where("split = 'test'").groupBy("ds").count().where("count > 1").count()
    assert test_rows == 0


def test_rolling_folds_end_with_the_data(spark):
    folds = series.folds_rolling_origin(frame(spark, range(20)), ["k"], k=3, fold_pct=0.2, overlap_pct=0.5)
    spans = {
        r["fold"]: (r["a"], r["b"])
        for r in folds.where("split = 'test'").groupBy("fold").agg(F.min("y").alias("a"), F.max("y").alias("b")).collect()
    }
    assert spans == {1: (12.0, 15.0), 2: (14.0, 17.0), 3: (16.0, 19.0)}


def test_horizon_folds_match_their_cutoffs(spark):
    df = frame(spark, range(100)).unionByName(frame(spark, range(20), "short"))
    cutoffs = {r["cutoff"] for r in series.horizon_cutoffs(df, ["k"], 30, 20, 10).collect()}
    assert cutoffs == {day(89), day(69), day(49)}
    folds = series.folds_horizon(df, ["k"], 30, 20, 10)
    rows = folds.groupBy("cutoff", "split").agg(F.min("ds").alias("a"), F.max("ds").alias("b"), F.count("*").alias("n")).collect()
    assert {r["cutoff"] for r in rows} == cutoffs
    for r in rows:
        if r["split"] == "train":
            assert (r["a"], r["b"]) == (day(0), r["cutoff"])
        else:
            assert r["n"] == 10 and r["a"] == r["cutoff"] + dt.timedelta(days=1)


def test_future_frames(spark):
    df = frame(spark, [1, 2])
    weeks = sorted(r["ds"] for r in series.future_frame(df, ["k"], 2, "week").collect())
    assert weeks == [day(8), day(15)]
    months = sorted(r["ds"] for r in series.future_frame(df, ["k"], 2, "month").collect())
    assert months == [dt.date(2020, 2, 29), dt.date(2020, 3, 31)]
    assert series.future_frame(df, ["k"], 3, history=True).count() == 5


def test_step_and_seasons(spark):
    weekly = spark.createDataFrame([("w", day(7 * i)) for i in range(120)], "k string, ds date")
    daily = spark.createDataFrame([("d", day(i)) for i in range(20)], "k string, ds date")
    got = {r["k"]: r for r in series.auto_seasonality(weekly.unionByName(daily), ["k"]).collect()}
    assert (got["w"]["step_days"], got["w"]["yearly"], got["w"]["weekly"]) == (7, True, False)
    assert (got["d"]["step_days"], got["d"]["yearly"], got["d"]["weekly"], got["d"]["daily"]) == (1, False, True, False)


def test_decomposition_adds_up(spark):
    df = frame(spark, [i * 0.5 + (3 if i % 7 == 0 else 0) for i in range(28)])
    parts = [r for r in stats.decompose(df, ["k"]).orderBy("ds").collect()]
    assert parts[2]["trend"] is None and parts[3]["trend"] is not None
    for r in parts[3:-3]:
        assert r["trend"] + r["seasonal"] + r["resid"] == pytest.approx(r["y"])
    assert sum({r["ds"].weekday(): r["seasonal"] for r in parts}.values()) == pytest.approx(0)


def test_elasticity_is_null_when_the_price_stands_still(spark):
    df = spark.createDataFrame(
        [("i", day(0), 10, 1.0), ("i", day(1), 20, 1.0), ("i", day(2), 10, 2.0)],
        "item string, date date, sales long, sell_price double",
    )
    got = [r["elasticity"] for r in stats.price_elasticity(df).orderBy("date").collect()]
    assert got == [None, -0.5]


def test_autocorrelation_equals_numpy(spark):
    import numpy as np

    v = np.sin(np.arange(30)) + np.arange(30) * 0.1
    got = {r["lag"]: r["acf"] for r in stats.autocorrelation(frame(spark, v), ["k"], "y", 5).collect()}
    e = v - v.mean()
    for k in range(1, 6):
        assert got[k] == pytest.approx((e[k:] * e[:-k]).sum() / (e * e).sum())


def test_random_walk_needs_a_difference_and_noise_does_not(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    noise = rng.normal(size=300)
    df = frame(spark, noise, "noise").unionByName(frame(spark, noise.cumsum() + 0.5 * np.arange(300), "walk"))
    got = {r["k"]: r["suggested_d"] for r in stats.stationarity(df, ["k"]).collect()}
    assert got == {"noise": 0, "walk": 1}


def test_metric_values(spark):
    pairs = [(0.0, 1.0), (2.0, 2.0), (4.0, 3.0), (4.0, 5.0)]
    df = spark.createDataFrame([("s", day(i), y, p) for i, (y, p) in enumerate(pairs)], "k string, ds date, y double, yhat double")
    m = evaluation.forecast_metrics(df, ["k"]).first()
    assert (m["mae"], m["mse"], m["mase"]) == (0.75, 0.75, 0.5625)
    assert m["rmse"] == pytest.approx(0.866025, abs=1e-6)
    assert m["mape_nonzero"] == pytest.approx(16.666667, abs=1e-6)
    assert m["smape"] == pytest.approx(62.698413, abs=1e-6)
    assert m["r2"] == pytest.approx(0.727273, abs=1e-6)
    assert m["mape"] > 1e15


def test_mase_of_a_constant_series_is_null(spark):
    df = frame(spark, [5] * 4).withColumn("yhat", F.lit(4.0))
    assert evaluation.forecast_metrics(df, ["k"]).first()["mase"] is None


def test_all_zero_actuals_have_no_percentage_error(spark):
    df = frame(spark, [0, 0]).withColumn("yhat", F.lit(1.0))
    assert evaluation.basic_metrics(df, ["k"]).first()["mape"] is None


def test_classification_report(spark):
    pairs = [(1, 1)] * 3 + [(1, 0)] + [(0, 0)] * 4 + [(0, 1)] * 2
    df = spark.createDataFrame(pairs, "l int, p int")
    got = {r["class"]: r for r in evaluation.classification_report(df, "l", "p").collect()}
    assert (got[1]["precision"], got[1]["recall"], got[1]["support"]) == (0.6, 0.75, 4)
    assert got[0]["accuracy"] == 0.7


def test_conformal_width_interpolates(spark):
    cal = spark.createDataFrame([("s", float(i), 0.0) for i in range(1, 11)], "k string, y double, yhat double")
    out = intervals.conformal_naive(cal, spark.createDataFrame([("s", 20.0)], "k string, yhat double"), ["k"], alpha=0.2)
    row = out.first()
    assert row["qhat"] == pytest.approx(8.2) and row["yhat_upper"] == pytest.approx(28.2)


def test_fourier_terms_follow_the_condition(spark):
    df = frame(spark, [1, 1])
    on, off = (
        df.select(series.fourier(F.col("ds"), 7, 1, F.lit(c))[1].alias("x")).first()["x"] for c in (1, 0)
    )
    days = (D0 - dt.date(1970, 1, 1)).days
    assert on == pytest.approx(math.cos(2 * math.pi * days / 7)) and off == 0


def test_normalised_values(spark):
    df = frame(spark, [0, 5, 10]).unionByName(frame(spark, [100, 100], "flat"))
    local = {(r["k"], r["ds"]): r["y_norm"] for r in series.normalise(df, ["k"]).collect()}
    assert local[("s", day(1))] == 0.5 and local[("flat", day(0))] is None
    overall = series.normalise(df, ["k"], local=False).agg(F.max("y_norm")).first()[0]
    assert overall == 1.0


def test_shares_and_splits_known_before_empty_days_are_made(spark):
    rows = [("a", 0, 2.0), ("a", 1, 0.0), ("a", 40, 3.0), ("b", 3, 1.0), ("c", 5, 4.0), ("c", 7, 4.0)]
    daily = spark.createDataFrame([(k, dt.date(2000, 1, 1) + dt.timedelta(n), y) for k, n, y in rows], "k string, ds date, y double")
    found = daily.select("k", series.empty_share(["k"]).alias("zero_ratio")).distinct()
    dense = series.daily_series(daily, ["k"], date="ds", value="y", flags=False)
    assert sorted(found.collect()) == sorted(series.zero_ratio(dense, ["k"]).collect())
    given = series.daily_totals(daily, ["k"], date="ds", value="y", grouped=True).withColumn("_last", series.last_day(["k"]))
    filled = series.densify(given, ["k"], "ds", {"y": F.lit(0.0)})
    split = series.split_tail_days(filled, ["k"], 28, last="_last").drop("_last")
    assert sorted(split.collect()) == sorted(series.split_tail_days(dense, ["k"], 28).collect())
