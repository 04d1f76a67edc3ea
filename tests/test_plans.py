"""What the physical plans must and must not contain."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from orderline_kpi.operators import correlation_matrix
from orderline_kpi.operators.kpi import kpi
from orderline_kpi.plans.catalog import KPIS
from orderline_kpi.plans.queries import QUERIES
from orderline_kpi.sources import order_lines

LAZY = sorted(name for name in QUERIES if name != "ml_late_risk_auc")  # a number when it comes back


def plan_of(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(name, spark, tables_dir):
    plan = plan_of(QUERIES[name](spark, tables_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert operator not in plan


@pytest.mark.parametrize("name", ["monthly_trend", "regional_performance", "ml_dataset"])
def test_nothing_is_broadcast_regardless_of_size(name, spark, tables_dir, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(QUERIES[name](spark, tables_dir))
    assert "Broadcast" not in plan
    assert "SortMergeJoin" in plan


def test_scan_reads_only_what_is_used(spark, tables_dir):
    plan = plan_of(QUERIES["shipping_mode_performance"](spark, tables_dir), "formatted")
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", plan)
    assert sorted(schemas) == [
        "l_orderkey:bigint,l_shipdate:timestamp_ntz",
        "o_orderkey:bigint,o_orderdate:timestamp_ntz,o_orderpriority:string",
    ]


@pytest.mark.parametrize("name, joins", [
    ("product_performance", 1), ("shipping_mode_performance", 1), ("category_contribution", 1), ("category_summary", 1),
    ("monthly_trend", 2), ("customer_segment", 3), ("regional_performance", 5), ("regional_sales_share", 5 * 2),
])
def test_only_needed_tables_are_joined_and_once(name, joins, spark, tables_dir, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(QUERIES[name](spark, tables_dir), "formatted")
    assert len(re.findall(r"^\(\d+\) (?:BroadcastHash|SortMerge|ShuffledHash)Join", plan, re.M)) == joins
    if name != "regional_sales_share":  # there the total is a subquery over the same table
        assert len(re.findall(r"Location: .*lineitem", plan)) == 1


def test_what_no_report_shows_is_not_computed(spark, tables_dir):
    assert "order_id" not in plan_of(QUERIES["regional_sales_share"](spark, tables_dir))


def test_distinct_orders_need_no_shuffle_behind_the_order_join(spark, tables_dir, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(QUERIES["monthly_trend"](spark, tables_dir))
    assert re.search(r"HashAggregate\(keys=\[_groupingexpression#\w+, order_id#\w+\]", plan)
    assert not re.search(r"Exchange hashpartitioning\([^)]*order_id", plan)


def test_measures_do_not_travel_with_counted_values_of_a_stored_table(spark, tables_dir):
    lines = order_lines(spark, tables_dir, ["category", "order_id", "sales", "profit"])
    plan = plan_of(kpi(lines, KPIS["category_summary"], separate_distinct=True))
    by_order = re.findall(r"HashAggregate\(keys=\[category#\w+, order_id#\w+\], functions=\[(.*)\]\)", plan)
    assert by_order and set(by_order) == {""}
    assert re.search(r"Exchange hashpartitioning\(category#\w+, order_id", plan)


def test_two_distinct_counts_do_not_multiply_rows(spark, tables_dir):
    assert "Expand" not in plan_of(QUERIES["summary_statistics"](spark, tables_dir))


def test_counts_of_the_summary_read_what_they_count_and_store_nothing(spark, tables_dir):
    plan = plan_of(QUERIES["summary_statistics"](spark, tables_dir), "formatted")
    assert set(re.findall(r"Location: .*/(\w+)\.parquet", plan)) == {"lineitem", "orders", "part"}
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", plan)
    assert {"l_orderkey:bigint", "o_orderkey:bigint,o_custkey:bigint"} <= set(schemas)


def test_correlation_sends_one_row_per_pair_and_task(spark):
    names = [f"c{i}" for i in range(25)]
    sparse = spark.range(0, 4000, 1, 4).select([
        F.when(F.pmod(F.hash("id", F.lit(i)), F.lit(2)) == 0, F.rand(i)).alias(c) for i, c in enumerate(names)])
    plan = plan_of(correlation_matrix(sparse, names))
    assert re.search(r"Exchange hashpartitioning\(slot#", plan) and "Window" not in plan
    assert len(re.findall("partial_covar_pop", plan)) == 1


@pytest.mark.parametrize("name", ["category_top10", "product_top10_sales", "product_bottom10_sales"])
def test_top_lists_do_not_sort_everything(name, spark, tables_dir):
    plan = plan_of(QUERIES[name](spark, tables_dir))
    assert "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan


def test_correlation_stays_in_generated_code(spark, tables_dir, setting):
    setting("spark.sql.adaptive.enabled", "false")
    from orderline_kpi.schema import NUMERIC_COLUMNS

    plan = plan_of(correlation_matrix(order_lines(spark, tables_dir, NUMERIC_COLUMNS)))
    partial = [line for line in plan.splitlines() if "partial_covar_pop" in line]
    assert partial and all(re.search(r"\*\(\d+\) HashAggregate", line) for line in partial)
