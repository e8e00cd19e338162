"""Checks on plans: what is scanned, shuffled and broadcast."""

import re
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillcast.operators import windows
from tillcast.plans import catalog
from tillcast.plans.retail_queries import in_year
from tillcast.sources.star import SalesStar


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan_text(df).split("== Initial Plan ==")[0]


def test_queries_are_listed_without_a_session():
    code = "import __spark_entry__ as e; assert len(e.queries()) > 200 and e.oracle_sql()"
    root = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_date_filter_and_columns_reach_the_scan(spark, small):
    text = plan_text(SalesStar(spark, small).fact("sales", "date", where=in_year()))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "GreaterThanOrEqual(l_shipdate" in scan and "LessThan(l_shipdate" in scan
    assert "ReadSchema: struct<l_quantity:double,l_shipdate" in scan
    assert "Join" not in text


def test_unused_dimensions_are_not_joined(spark, small):
    star = SalesStar(spark, small)
    assert "part.parquet" not in plan_text(star.fact("region", "sales"))
    assert "supplier.parquet" not in plan_text(star.fact("category", "sales"))


def test_large_dimensions_are_not_broadcast(spark, small):
    """Beyond the row limit the lines are grouped by foreign key before they meet a dimension."""
    star = SalesStar(spark, small, broadcast_rows=0)
    text = star.summarise(["category"], total=("sum", "sales"))._jdf.queryExecution().optimizedPlan().toString()
    join = text.index("Join LeftOuter")
    assert "Aggregate [_part" in text[join:]
    assert "strategy=broadcast" not in text


@pytest.mark.parametrize("by", [["category"], ["store"], ["region", "yearweek", "store"]])
def test_moments_of_large_dimensions_join_grouped_rows(spark, small, by):
    star = SalesStar(spark, small, broadcast_rows=0)
    df = star.summarise(by, std=("std", "sales"), corr=("corr", ("sales", "sell_price")))
    text = df._jdf.queryExecution().optimizedPlan().toString()
    join = text.index("Join LeftOuter")
    assert "Aggregate [" in text[join:] and "strategy=broadcast" not in text


def test_attribute_filters_come_before_grouping(spark, small):
    star = SalesStar(spark, small, broadcast_rows=0)
    df = star.summarise(["store_code"], item_where=F.col("department") == "x", n=("count", "sales"))
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Aggregate [") < text.index("Join LeftSemi")


def test_calendar_is_broadcast(spark, small):
    text = plan_text(catalog.run("join_calendar", spark, small))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_share_reads_the_lines_once(spark, small):
    text = final_plan(catalog.run("win_share_store_week", spark, small))
    assert len(re.findall(r"FileScan.*lineitem", text)) == 1
    assert "Window" not in text


def test_top_n_is_limited_before_the_shuffle(spark, small):
    assert "WindowGroupLimit" in plan_text(catalog.run("win_top_n_per_group", spark, small))
    assert "TakeOrderedAndProject" in plan_text(catalog.run("top_items_sum", spark, small))


def test_series_steps_share_one_partitioning(spark, small):
    """Densify, outliers and refill run on the exchange of the daily totals by key."""
    text = final_plan(catalog.run("ts_refill_after_clean", spark, small))
    assert text.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("name", ["win_cumulative", "st_acf", "ts_cv_horizon", "fc_cell_mean", "flt_quantile_cap", "rsh_melt_days"])
def test_no_cartesian_product(spark, small, name):
    text = plan_text(catalog.run(name, spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_windows_over_the_raw_rows_are_avoided(spark, small):
    rows = SalesStar(spark, small).fact("store_code", "date", "sales")
    df = windows.cumulative_by_date(rows, ["store_code"], "date", "sales", "c")
    text = df._jdf.queryExecution().optimizedPlan().toString()
    window = text.index("Window [")
    assert "Aggregate [store_code" in text[window:]


def test_dates_are_shown_as_text(spark, small):
    df = catalog.presentable(SalesStar(spark, small).fact("date", "sell_price").where(F.lit(True)))
    assert [f.dataType.simpleString() for f in df.schema] == ["string", "double"]


def test_single_stores_meet_a_large_item_dimension_before_grouping(spark, small):
    star = SalesStar(spark, small)
    star._row_counts = {"part": 10**9, "supplier": 1}
    df = star.summarise(["region", "department", "store"], total=("sum", "sales"))
    text = df._jdf.queryExecution().optimizedPlan().toString()
    # The first grouping is by store key and item attribute, not by item.
    first = text[text.rindex("Aggregate [") :].splitlines()[0]
    assert "_supp" in first and "department" in first and "_part" not in first
    expected = SalesStar(spark, small).summarise(["region", "department", "store"], total=("sum", "sales"))
    assert sorted(df.collect()) == sorted(expected.collect())
