"""Every query against its SQL counterpart in DuckDB, value for value."""

import pytest

import __spark_entry__ as contract
from conftest import rows_of

from orderline_kpi.plans.oracle import ORACLE_SQL as ORACLE
from orderline_kpi.plans.queries import QUERIES


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(name, spark, duck, tables_dir):
    got = QUERIES[name](spark, tables_dir).toPandas()
    expected = duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows_of(got) == rows_of(expected)


SORTED = {
    "monthly_trend", "monthly_first12", "category_contribution", "category_top10",
    "shipping_mode_performance", "regional_performance", "customer_segment", "hourly_pattern",
    "weekday_pattern", "order_status_distribution", "category_summary",
    "product_top10_sales", "product_top10_profit", "product_bottom10_sales",
}


@pytest.mark.parametrize("name", sorted(SORTED))
def test_rows_come_in_order(name, spark, duck, tables_dir):
    got = QUERIES[name](spark, tables_dir).toPandas()
    expected = duck.execute(ORACLE[name]).df()
    key = got.columns[0]
    assert got[key].tolist() == expected[key].tolist()


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["order_month", "orders", "sales", "profit", "late_rate"]
    assert result.count() > 0
