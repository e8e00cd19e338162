"""Row operators, windows, joins and the fact built from raw tables, on small worked frames."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tillcast import schemas
from tillcast.functions import dates, scalars
from tillcast.operators import aggregates, joins, reshape, rows, stats, windows
from tillcast.operators.quantiles import exact_quantiles
from tillcast.plans.etl import build_fact
from tillcast.sources import files, sinks
from tillcast.sources.shared import new_path
from tillcast.sources.star import SalesStar


def values(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.select(*columns).collect()]


def test_iso_weeks_at_year_edges(spark):
    days = [dt.date(2012, 12, 31), dt.date(2015, 12, 27), dt.date(2016, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(dates.iso_yearweek(F.col("d"))).collect()]
    assert got == [201301, 201552, 201553]
    first, last = dates.week_dates(201553)
    assert (first, last) == (dt.date(2015, 12, 28), dt.date(2016, 1, 3))


def test_price_weeks_are_filled_and_raised(spark):
    prices = spark.createDataFrame(
        [("a", "c", "s", w, 1.0) for w in (201101.0, 201101.0, None, 201105.0)]
        + [("b", "c", "s", 201110.0, 2.0)],
        schemas.PRICES,
    )
    repaired = windows.repair_price_weeks(prices)
    assert sorted(values(repaired.where("item = 'a'"), "yearweek")) == [
        (201101,), (201102,), (201105,), (201106,),
    ]
    assert values(repaired.where("item = 'b'"), "yearweek") == [(201110,)]


def test_monotone_weeks_equal_the_loop(spark):
    rng = random.Random(7)
    data = {f"k{i}": sorted(rng.randint(1, 12) for _ in range(rng.randint(1, 15))) for i in range(20)}
    df = spark.createDataFrame([(k, w) for k, ws in data.items() for w in ws], "k string, yearweek int")
    got = {}
    for k, w in values(windows.monotone_weeks(df, ["k"]), "k", "yearweek"):
        got.setdefault(k, []).append(w)
    for k, weeks in data.items():
        last, want = None, []
        for w in weeks:
            last = w if last is None or w > last else last + 1
            want.append(last)
        assert sorted(got[k]) == want


def test_duplicates_count_rows_after_the_first(spark):
    df = spark.createDataFrame([("a", "s", 1), ("a", "s", 1), ("a", "s", 2)], "item string, store_code string, yearweek int")
    assert values(windows.duplicate_counts(df, ["item", "store_code", "yearweek"]), "yearweek", "duplicates") == [(1, 1)]


def test_share_keeps_null_groups(spark):
    df = spark.createDataFrame([(None, "a", 1), (None, "b", 3), ("x", "a", 5)], "g string, k string, total long")
    got = {(g, k): s for g, k, s in values(windows.share_of_group(df, ["g"], "total", "share"), "g", "k", "share")}
    assert got == {(None, "a"): 25.0, (None, "b"): 75.0, ("x", "a"): 100.0}


def test_cumulative_rows_of_one_date_share_the_value(spark):
    df = spark.createDataFrame(
        [("s", dt.date(2020, 1, 1), 1), ("s", dt.date(2020, 1, 1), 2), ("s", dt.date(2020, 1, 2), 3)],
        "k string, date date, sales long",
    )
    got = values(windows.cumulative_by_date(df, ["k"], "date", "sales", "c"), "sales", "c")
    assert sorted(got) == [(1, 3), (2, 3), (3, 6)]


def test_changes_are_null_after_zero_and_at_the_start(spark):
    df = spark.createDataFrame([("r", 1, 10), ("r", 2, 0), ("r", 3, 5)], "k string, w int, s long")
    got = values(windows.lag_change(df, ["k"], "w", "s", "c").orderBy("w"), "c")
    assert got == [(None,), (-100.0,), (None,)]


def test_year_on_year_needs_the_same_week(spark):
    df = spark.createDataFrame([("s", 201501, 10), ("s", 201601, 15), ("s", 201553, 4)], "k string, w int, s long")
    got = dict(values(windows.year_on_year(df, ["k"], "w", "s", "c"), "w", "c"))
    assert got == {201501: None, 201601: 50.0, 201553: None}


def test_top_n_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("s", "b", 5), ("s", "a", 5), ("s", "c", 9), ("s", "d", 1)], "store string, item string, t long")
    got = values(windows.top_n_per_group(df, ["store"], "t", "item", 2).orderBy("rank"), "item")
    assert got == [("c",), ("a",)]


def test_rolling_waits_for_a_full_window(spark):
    df = spark.createDataFrame([("s", i, float(i)) for i in range(8)], "k string, o int, y double")
    got = values(windows.rolling_stats(df, ["k"], "o", "y", 7).orderBy("o"), "rolling_mean_7")
    assert got[:6] == [(None,)] * 6 and got[6:] == [(3.0,), (4.0,)]


@pytest.mark.parametrize("accuracy", [50_000, 20])
def test_exact_quantiles_equal_sorting(spark, monkeypatch, accuracy):
    """With a coarse sketch the bracket is cut from a large group; ranks stay exact."""
    import numpy as np

    from tillcast.operators import quantiles

    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    rng = np.random.default_rng(3)
    groups = {
        "hot": rng.lognormal(0, 2, 4000).tolist(),
        "ties": [1.0] * 500 + [2.0] * 500 + [50.0],
        "one": [7.0],
        None: [1.0, 2.0],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("hot", None)], "g string, v double").repartition(8)
    probs = {"p05": 0.05, "p50": 0.5, "p95": 0.95}
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    for g, vs in groups.items():
        for name, q in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(vs, q), rel=1e-12), (g, name)
    everything = exact_quantiles(df, [], "v", {"m": 0.5}).first()["m"]
    assert everything == pytest.approx(np.quantile([v for vs in groups.values() for v in vs], 0.5))


def test_cap_by_quantile_uses_the_uncut_table(spark):
    df = spark.createDataFrame([(i, float(i), float(-i)) for i in range(1, 101)], "id int, a double, b double")
    kept = {r[0] for r in rows.cap_by_quantile(df, ["a", "b"]).select("id").collect()}
    assert kept == set(range(6, 96))


def test_clean_fact_fills_events_and_prices(spark):
    df = spark.createDataFrame(
        [("c", "d", "d_1", None, None, 1), ("c", "d", "d_2", "E", 1.239, 2)],
        "category_x string, category_y string, d string, event string, sell_price double, sales int",
    )
    clean = rows.clean_fact(df)
    assert clean.columns == ["category", "event", "sell_price", "sales"]
    assert sorted(values(clean, "event", "sell_price")) == [("", 0.0), ("E", 1.24)]


def test_numeric_rows_drop_bad_values(spark):
    df = spark.createDataFrame([("1.5", "2"), ("x", "3"), (None, "4")], "a string, b string")
    assert values(rows.numeric_rows(df, ["a", "b"]), "a", "b") == [(1.5, 2.0)]


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert values(aggregates.null_counts(df), "a", "b") == [(1, 2)]


def test_constant_column_has_one_bin(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert values(aggregates.histogram(df, "x", 10), "bin", "rows") == [(0, 2)]


def test_event_windows_cross_a_month_edge(spark):
    events = spark.createDataFrame([("NewYear", dt.date(2020, 1, 1), -1, 1)], schemas.EVENTS)
    days = {r["ds"] for r in joins.expand_events(events).collect()}
    assert days == {dt.date(2019, 12, 31), dt.date(2020, 1, 1), dt.date(2020, 1, 2)}


def test_event_rules_name_different_days(spark):
    df = spark.createDataFrame([(dt.date(2015, 12, d), None) for d in (23, 24, 25, 26)], "d date, e string")
    december = values(df.select(dates.december_events(F.col("d"), F.col("e")).alias("x")), "x")
    natal = values(df.select(dates.natal_events(F.col("d"), F.col("e")).alias("x")), "x")
    assert december == [("Natal D-2",), ("Natal D-1",), (None,), ("Boxing Day",)]
    assert natal == [(None,), (None,), ("Natal",), (None,)]


def test_one_hot_with_and_without_null_column(spark):
    df = spark.createDataFrame([("a",), (None,)], "event string")
    assert reshape.one_hot(df, "event", ["a"]).columns == ["event_a", "event_other"]
    got = values(reshape.one_hot(df, "event", ["a"], null_column=True), "event_a", "event_nan")
    assert got == [(1, 0), (0, 1)]


def test_wide_results_sum_what_is_not_named(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", 3), (1, None, 4), (2, "c", 5)], "k int, c string, v int")
    got = {tuple(r) for r in reshape.pivot_sum(df, ["k"], "c", "v", ["a", "b"]).collect()}
    assert got == {(1, 2, 3, 4), (2, 0, 0, 5)}


def test_shapes_do_not_depend_on_the_number_of_stores(spark):
    for n in (10, 3000):
        df = spark.range(n).selectExpr("id AS store", "'PROMO' AS category", "id AS total_sales")
        wide = reshape.pivot_sum(df, ["store"], "category", "total_sales", ["PROMO", "LARGE"])
        assert wide.columns == ["store", "PROMO", "LARGE", "other"] and wide.count() == n


def test_correlation_counts_missing_days_as_zero(spark):
    import numpy as np

    data = [("a", 1, 2), ("a", 2, 5), ("a", 4, 1), ("b", 1, 3), ("b", 3, 7), ("b", 4, 4)]
    df = spark.createDataFrame(data, "k string, d int, v bigint")
    got = {(r.a, r.b): r["corr"] for r in stats.correlation_matrix(df, "k", "d", "v").collect()}
    assert set(got) == {("a", "a"), ("a", "b"), ("b", "b")}
    assert got["a", "b"] == pytest.approx(np.corrcoef([2, 5, 0, 1], [3, 0, 7, 4])[0, 1])


def test_required_columns(spark):
    with pytest.raises(ValueError, match="sales"):
        schemas.require_columns(spark.range(1), {"id", "sales"})


def test_significant_digits(spark):
    df = spark.createDataFrame([(1.23456789e17,), (0.0,)], "x double")
    assert values(df.select(scalars.significant(F.col("x"), 3).alias("x")), "x") == [(1.23e17,), (0.0,)]


def test_jdbc_reads_are_split_by_range():
    options = files.jdbc_options("jdbc:x", "t", column="id", bounds=(1, 100), partitions=8)
    assert options["fetchsize"] == "50000" and options["numPartitions"] == "8"
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"]) == ("id", "1", "100")
    with pytest.raises(ValueError):
        files.jdbc_options("jdbc:x", "t", column="id")


def test_rows_per_partition_add_up(spark):
    assert sinks.rows_per_partition(spark.range(100).repartition(5)).agg(F.sum("rows")).first()[0] == 100


def test_fact_from_csv_files(spark):
    """Wide sales, calendar and prices as files; a missing price stays NULL, no row is lost."""
    folder = new_path(spark, "raw")
    ids = [("1", "i1", "C", "C_1", "S", "s_1", "R"), ("2", "i2", "C", "C_1", "S", "s_1", "R")]
    wide = [(*ids[0], 1, 0, 2), (*ids[1], 0, 0, 0)]
    spark.createDataFrame(wide, schemas.sales_wide_schema(3)).write.csv(f"{folder}/sales", header=True)
    calendar = [(dt.date(2015, 12, 31), "d_1", None), (dt.date(2016, 1, 1), "d_2", "NewYear"), (dt.date(2016, 1, 4), "d_3", None)]
    spark.createDataFrame(calendar, schemas.CALENDAR).write.csv(f"{folder}/calendar", header=True)
    prices = [("i1", "P", "s_1", 201553.0, 1.5)]
    spark.createDataFrame(prices, schemas.PRICES).write.csv(f"{folder}/prices", header=True)
    fact = build_fact(
        files.read_sales_wide(spark, f"{folder}/sales"),
        files.read_calendar(spark, f"{folder}/calendar"),
        files.read_prices(spark, f"{folder}/prices"),
    )
    assert fact.columns == schemas.FACT.names
    got = sorted(values(fact, "item", "d", "sales", "yearweek", "event", "sell_price", "category_price"))
    assert got == [
        ("i1", "d_1", 1, 201553, None, 1.5, "P"),
        ("i1", "d_2", 0, 201553, "NewYear", 1.5, "P"),
        ("i1", "d_3", 2, 201601, None, None, None),
        ("i2", "d_1", 0, 201553, None, None, None),
        ("i2", "d_2", 0, 201553, "NewYear", None, None),
        ("i2", "d_3", 0, 201601, None, None, None),
    ]


@pytest.mark.parametrize("by", [["category"], ["store", "date"], ["region", "department"], ["event"]])
def test_large_and_small_dimensions_give_the_same(spark, small, by):
    measures = {
        "total": ("sum", "sales"), "n": ("count", "sales"), "mean": ("avg", "sell_price"),
        "low": ("min", "sales"), "high": ("max", "sell_price"),
    }
    joined = SalesStar(spark, small).summarise(by, **measures)
    grouped_first = SalesStar(spark, small, broadcast_rows=0).summarise(by, **measures)
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, grouped_first.collect()), key=str)


def test_cluster_statistics_are_one_row_each(spark):
    for n in (20, 3000):
        df = spark.range(n).selectExpr("cast(id % 2 AS int) AS cluster", "cast(id AS double) AS x")
        got = {r["cluster"]: r["members"] for r in aggregates.cluster_stats(df, ["x"]).collect()}
        assert got == {0: n // 2, 1: n // 2}


def test_describe_by_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 5)], "g string, v int")
    got = {r["g"]: (r["count"], r["mean"], r["std"], r["p50"], r["max"]) for r in aggregates.describe(df, "v", ["g"]).collect()}
    assert got["b"] == (1, 5.0, None, 5.0, 5.0) and got["a"][:2] == (2, 2.0) and got["a"][3:] == (2.0, 3.0)
    assert aggregates.describe(df, "v").first()["count"] == 3
