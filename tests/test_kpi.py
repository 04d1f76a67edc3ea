"""KPI tables, rankings and correlation on hand-made lines, and sums that must agree."""

import math
import random

import pandas as pd
import pytest

from orderline_kpi import (
    KPIS, Key, Kpi, MissingColumnsError, Order, correlation_matrix, kpi, ranked, run_all, shares,
)
from orderline_kpi.functions.measures import distinct, total
from orderline_kpi.plans.queries import QUERIES

SCHEMA = (
    "order_id bigint, customer_id bigint, product string, category string, region string, "
    "sales double, profit double, late double, ship_real double, ship_sched double"
)


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([
        (1, 1, "pen", "office", "West", 10.0, 4.0, 1.0, 3.0, 2.0),
        (1, 1, "ink", "office", "West", 30.0, None, 0.0, 1.0, 2.0),
        (2, 1, "pen", "office", "East", 20.0, -2.0, 1.0, 5.0, 2.0),
        (3, None, "map", "travel", "East", 0.0, 1.0, 0.0, 2.0, 2.0),
        (4, 2, "map", "travel", "North", 0.0, 1.0, None, 2.0, 2.0),
    ], SCHEMA)


def test_null_is_left_out_of_sum_and_mean(lines):
    west = {r.region: r for r in kpi(lines, KPIS["regional_performance"]).collect()}["West"]
    assert (west.total_sales, west.total_profit, west.total_orders) == (40.0, 4.0, 1)
    assert west.avg_profit_per_order == 4.0
    assert west.late_delivery_rate == 0.5


def test_margin_of_zero_sales_is_null(lines):
    rows = {r.category: r for r in kpi(lines, KPIS["category_summary"]).collect()}
    assert rows["travel"].profit_margin_pct is None
    assert rows["office"].profit_margin_pct == 2.0 / 60.0 * 100


def test_mean_without_any_value_is_null(lines):
    north = {r.region: r for r in kpi(lines, KPIS["regional_performance"]).collect()}["North"]
    assert north.late_delivery_rate is None


def test_summary(lines, spark):
    row = kpi(lines, KPIS["summary_statistics"]).first()
    assert (row.total_records, row.total_orders, row.total_customers) == (5, 4, 2)
    assert row.avg_sale == 12.0
    assert math.isclose(row.stddev_sales, pd.Series([10.0, 30, 20, 0, 0]).std())
    single = kpi(lines.where("product = 'ink'"), KPIS["summary_statistics"]).first()
    assert single.stddev_sales is None and single.total_profit is None
    empty = kpi(lines.where("product = 'none'"), KPIS["summary_statistics"]).first()
    assert (empty.total_records, empty.total_orders, empty.avg_sale) == (0, 0, None)


def test_a_kpi_of_ones_own(lines):
    spec = Kpi(
        "reach", keys=(Key("category"),), measures={"buyers": distinct("customer_id")},
        order=(Order("buyers", descending=True), Order("category")),
    )
    assert [tuple(r) for r in kpi(lines, spec).collect()] == [("office", 1), ("travel", 1)]
    overall = Kpi("all", keys=(), measures={"a": distinct("order_id"), "b": distinct("order_id")})
    assert tuple(kpi(lines, overall).first()) == (4, 4)


def test_null_groups_and_groups_without_a_counted_value_are_kept(spark):
    lines = spark.createDataFrame(
        [(None, 1, 5.0), (None, 1, 6.0), ("a", None, 7.0), ("b", 2, None)],
        "category string, order_id bigint, sales double",
    )
    spec = Kpi(
        "by_category", keys=(Key("category"),),
        measures={"orders": distinct("order_id"), "sales": total("sales")},
        order=(Order("category"),),
    )
    got = [(r.category, r.orders, r.sales) for r in kpi(lines, spec).collect()]
    assert got == [(None, 1, 11.0), ("a", 0, 7.0), ("b", 1, None)]


def test_tie_at_the_last_place_goes_by_name(spark):
    rows = [(f"p{i:02d}", "c", 100.0 - i) for i in range(9)]
    rows += [("zz", "c", 1.0), ("aa", "d", 1.0), ("aa", "c", 1.0)]
    table = spark.createDataFrame(rows, "product string, category string, total_sales double")
    top = ranked(table, Order("total_sales", descending=True), ["product", "category"])
    assert [tuple(r) for r in top.collect()][-1] == ("aa", "c", 1.0)
    assert top.count() == 10


def test_shares_add_up(spark):
    table = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "key string, n bigint")
    got = {r.key: r.share_pct for r in shares(table, "key", "n").collect()}
    assert got == {"a": 16.7, "b": 33.3, "c": 50.0}
    empty = shares(table.selectExpr("key", "0L AS n"), "key", "n").collect()
    assert {r.share_pct for r in empty} == {None}


def cells(df):
    return {(r.col_a, r.col_b): r.r for r in df.collect()}


def as_frame(lines, columns):
    frame = lines.select(columns).toPandas()
    return frame.corr()


def test_correlation_uses_pairwise_complete_rows(lines):
    columns = ["sales", "profit", "late", "ship_real"]
    got = cells(correlation_matrix(lines, columns, digits=9))
    expected = as_frame(lines, columns)
    assert len(got) == 16
    for (a, b), r in got.items():
        assert math.isclose(r, expected.loc[a, b], abs_tol=1e-8)


def test_correlation_over_many_patterns_of_missing_values(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(400):
        x = rng.gauss(1e6, 1)
        row = [x, 2 * x + rng.gauss(0, 1), rng.gauss(0, 1), rng.random(), rng.random() - x]
        rows.append([v if rng.random() < 0.7 else None for v in row])
    columns = ["sales", "profit", "late", "ship_real", "ship_sched"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(7)
    got = cells(correlation_matrix(df, columns, digits=9))
    expected = as_frame(df, columns)
    for (a, b), r in got.items():
        assert math.isclose(r, expected.loc[a, b], abs_tol=1e-7)


def test_correlation_of_many_sparse_columns(spark):
    rng = random.Random(6)
    columns = [f"c{i:02d}" for i in range(25)]
    rows = [[rng.random() if rng.random() < 0.5 else None for _ in columns[:-1]] + [1.0] for _ in range(500)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(5)
    got = cells(correlation_matrix(df, columns, digits=9))
    expected = as_frame(df, columns)
    assert len(got) == 25 * 25
    for (a, b), r in got.items():
        assert (r is None) == (columns[-1] in (a, b))
        assert r is None or math.isclose(r, expected.loc[a, b], abs_tol=1e-7)


def test_constant_column_has_no_correlation_not_even_with_itself(lines, spark):
    got = cells(correlation_matrix(lines, ["sales", "ship_sched"]))
    assert got == {
        ("sales", "sales"): 1.0, ("sales", "ship_sched"): None,
        ("ship_sched", "sales"): None, ("ship_sched", "ship_sched"): None,
    }
    tenth = spark.createDataFrame(
        [(float(i), 0.1, None if i == 2 else 0.1) for i in range(7)],
        "sales double, profit double, late double",
    )
    got = cells(correlation_matrix(tenth))
    assert {r for pair, r in got.items() if pair != ("sales", "sales")} == {None}


def test_correlation_of_columns_without_a_common_row(spark):
    df = spark.createDataFrame(
        [(1.0, None), (2.0, None), (None, 3.0), (None, 4.0)], "sales double, profit double"
    )
    got = cells(correlation_matrix(df))
    assert got[("sales", "profit")] is None
    assert got[("sales", "sales")] == got[("profit", "profit")] == 1.0
    assert cells(correlation_matrix(df.where("false"))) == dict.fromkeys(got)


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0), (2.0, 1.0), (3.0, float("nan")), (4.0, 7.0)], "sales double, profit double"
    )
    r = cells(correlation_matrix(df, digits=9))[("sales", "profit")]
    assert math.isclose(r, as_frame(df, ["sales", "profit"]).loc["sales", "profit"], abs_tol=1e-8)


def test_correlation_needs_two_columns(lines):
    with pytest.raises(MissingColumnsError):
        correlation_matrix(lines.select("sales"))


def test_run_all_reports_what_it_skips(lines):
    reports = run_all(lines)
    assert {"category_contribution", "product_top10_sales", "summary_statistics"} <= set(reports)
    assert "segment" in reports.skipped["customer_segment"]
    assert "order_status_share" in reports.skipped
    assert not set(reports) & set(reports.skipped)
    assert reports["product_bottom10_sales"].first()["product"] == "map"


def test_totals_agree_between_tables(spark, tables_dir):
    def total(name, column):
        return sum(r[column] for r in QUERIES[name](spark, tables_dir).collect())

    overall = QUERIES["summary_statistics"](spark, tables_dir).first()
    for name, column in [
        ("monthly_trend", "sales"), ("category_contribution", "sales"),
        ("regional_performance", "total_sales"), ("customer_segment", "total_sales"),
        ("product_performance", "total_sales"), ("order_status_distribution", "total_sales"),
    ]:
        assert math.isclose(total(name, column), overall.total_sales, rel_tol=1e-12)
    assert total("shipping_mode_performance", "total_orders") == overall.total_records
    assert abs(total("regional_sales_share", "share_pct") - 100) <= 0.5
    assert abs(total("order_status_share", "share_pct") - 100) <= 0.5
    assert total("ml_split_counts", "row_count") == QUERIES["ml_dataset"](spark, tables_dir).count()
