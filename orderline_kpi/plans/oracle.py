"""The same queries in DuckDB's SQL, on the same tables, to check results against.

Written on its own: nothing here is generated from the Spark side.
"""

from __future__ import annotations

_FACT = """
fact AS (
  SELECT
    l_orderkey AS order_id,
    o_custkey AS customer_id,
    o_orderdate AS order_dt,
    l_shipdate AS ship_dt,
    l_extendedprice::DECIMAL(12,2) AS sales,
    (l_extendedprice::DECIMAL(12,2) * (1::DECIMAL(3,2) - l_discount::DECIMAL(3,2))
      - l_quantity::DECIMAL(5,2) * p_retailprice::DECIMAL(12,2))::DECIMAL(18,4) AS profit,
    date_diff('day', o_orderdate, l_shipdate)::DOUBLE AS ship_real,
    left(o_orderpriority, 1)::DOUBLE AS ship_sched,
    CASE WHEN date_diff('day', o_orderdate, l_shipdate) > left(o_orderpriority, 1)::INT
         THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS late,
    o_orderpriority AS ship_mode,
    p_type AS category,
    r_name AS region,
    c_mktsegment AS segment,
    p_name AS product,
    o_orderstatus AS status
  FROM lineitem
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
)"""

_SALES = "sum(sales)::DOUBLE"
_PROFIT = "sum(profit)::DOUBLE"
_MEAN_SALES = "sum(sales)::DOUBLE / count(sales)"
_MEAN_PROFIT = "sum(profit)::DOUBLE / count(profit)"
_MARGIN = f"{_PROFIT} / nullif({_SALES}, 0) * 100"


def _on_fact(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([_FACT, *ctes]) + "\n" + select


_CLEAN_ROWS = """
SELECT sales::DOUBLE AS sales, profit::DOUBLE AS profit, late, ship_real, ship_sched,
       order_id, customer_id, category, ship_mode, region, segment, product, status,
       order_dt, ship_dt
FROM fact"""

_MONTHLY = f"""
SELECT strftime(order_dt, '%Y-%m') AS order_month, count(DISTINCT order_id) AS orders,
       {_SALES} AS sales, {_PROFIT} AS profit, avg(late) AS late_rate
FROM fact GROUP BY 1"""

_CATEGORY = f"""
SELECT category, {_SALES} AS sales, {_PROFIT} AS profit, count(DISTINCT order_id) AS orders
FROM fact GROUP BY 1"""

_SHIPPING = """
SELECT ship_mode, count(*) AS total_orders, avg(late) AS late_rate,
       avg(ship_real) AS avg_real_ship, avg(ship_sched) AS avg_sched
FROM fact GROUP BY 1"""

_REGIONAL = f"""
SELECT region, {_SALES} AS total_sales, {_PROFIT} AS total_profit,
       count(DISTINCT order_id) AS total_orders, {_MEAN_PROFIT} AS avg_profit_per_order,
       avg(late) AS late_delivery_rate, {_MARGIN} AS profit_margin
FROM fact GROUP BY 1"""

_PRODUCT = f"""
SELECT product, category, count(*) AS times_ordered, {_SALES} AS total_sales,
       {_PROFIT} AS total_profit, {_MEAN_SALES} AS avg_sale_price, {_MARGIN} AS profit_margin
FROM fact GROUP BY 1, 2"""

_STATUS = f"""
SELECT status, count(*) AS order_count, {_SALES} AS total_sales, {_PROFIT} AS total_profit,
       avg(late) AS avg_late_risk
FROM fact GROUP BY 1"""

_ON_EVENTS = """
SELECT {keys}, count(*) AS order_count,
       sum(value::DECIMAL(18,2))::DOUBLE AS total_sales,
       sum(value::DECIMAL(18,2))::DOUBLE / count(value) AS avg_sales
FROM events GROUP BY {group}"""

_DATASET = """dataset AS (
  SELECT order_id, late::INT AS label, ship_real, ship_sched, ship_mode, category, region,
         sales::DOUBLE AS sales
  FROM fact
  WHERE late IS NOT NULL AND ship_real IS NOT NULL AND ship_sched IS NOT NULL
    AND ship_mode IS NOT NULL AND category IS NOT NULL AND region IS NOT NULL
    AND sales IS NOT NULL
)"""


_IS_TEST = "left(md5('42:' || order_id::VARCHAR), 8) >= 'cccccccc'"


def _index_of(feature: str) -> str:
    return f"""{feature}_index AS (
  SELECT {feature} AS value,
         row_number() OVER (ORDER BY count(*) DESC, {feature}) - 1 AS idx
  FROM dataset GROUP BY {feature}
)"""


_INDEXES = tuple(_index_of(feature) for feature in ("ship_mode", "category", "region"))

_MODES = "(SELECT count(*) FROM ship_mode_index)"
_CATEGORIES = "(SELECT count(*) FROM category_index)"
_REGIONS = "(SELECT count(*) FROM region_index)"

_NUMERIC = ("sales", "profit", "late", "ship_real", "ship_sched")
_CORRELATIONS = "\nUNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 3) AS r FROM fact"
    for a in _NUMERIC for b in _NUMERIC
)

_INFERRED = ", ".join(
    f"({position}, '{name}', '{data_type}')"
    for position, (name, data_type) in enumerate((
        ("order date (DateOrders)", "string"),
        ("shipping date (DateOrders)", "string"),
        ("Sales", "double"),
        ("Order Profit Per Order", "double"),
        ("Late_delivery_risk", "double"),
        ("Days for shipping (real)", "double"),
        ("Days for shipment (scheduled)", "double"),
        ("Order Id", "int"),
        ("Customer Id", "int"),
        ("Category Name", "string"),
        ("Shipping Mode", "string"),
        ("Order Region", "string"),
        ("Customer Segment", "string"),
        ("Product Name", "string"),
        ("Order Status", "string"),
    ), start=1)
)

ORACLE_SQL: dict[str, str] = {
    "ingest_csv_clean": _on_fact(_CLEAN_ROWS),
    "ingest_profile": _on_fact("SELECT count(*) AS row_count, 15::INT AS column_count FROM fact"),
    "ingest_schema": "SELECT position::INT AS position, column_name, data_type "
    f"FROM (VALUES {_INFERRED}) AS t(position, column_name, data_type)",
    "curated_roundtrip": _on_fact(_CLEAN_ROWS),
    "clean_preview": _on_fact("""
SELECT order_dt, sales::DOUBLE AS sales, profit::DOUBLE AS profit, late FROM fact
ORDER BY order_dt NULLS FIRST, fact.sales NULLS FIRST, fact.profit NULLS FIRST,
         late NULLS FIRST
LIMIT 5"""),
    "monthly_trend": _on_fact(_MONTHLY + " ORDER BY order_month NULLS FIRST"),
    "monthly_first12": _on_fact(_MONTHLY + " ORDER BY order_month NULLS FIRST LIMIT 12"),
    "category_contribution": _on_fact(_CATEGORY + " ORDER BY 2 DESC NULLS LAST, 1"),
    "category_top10": _on_fact(_CATEGORY + " ORDER BY 2 DESC NULLS LAST, 1 LIMIT 10"),
    "shipping_mode_performance": _on_fact(_SHIPPING + " ORDER BY 3 DESC NULLS LAST, 1"),
    "shipping_days_series": _on_fact(
        """SELECT ship_mode, 'Actual' AS series, avg_real_ship AS days FROM shipping
UNION ALL SELECT ship_mode, 'Scheduled', avg_sched FROM shipping""",
        f"shipping AS ({_SHIPPING})",
    ),
    "regional_performance": _on_fact(_REGIONAL + " ORDER BY 2 DESC NULLS LAST, 1"),
    "regional_sales_share": _on_fact(
        """SELECT region, total_sales,
       round(total_sales / sum(total_sales) OVER () * 100, 1) AS share_pct FROM regional""",
        f"regional AS ({_REGIONAL})",
    ),
    "regional_bubble": _on_fact(
        """SELECT region, total_orders, late_delivery_rate,
       total_sales / 10000 AS bubble_size, profit_margin FROM regional""",
        f"regional AS ({_REGIONAL})",
    ),
    "customer_segment": _on_fact(f"""
SELECT segment, count(DISTINCT order_id) AS total_orders, {_SALES} AS total_sales,
       {_PROFIT} AS total_profit, {_MEAN_SALES} AS avg_order_value,
       {_MEAN_PROFIT} AS avg_profit_per_order
FROM fact GROUP BY 1 ORDER BY 3 DESC NULLS LAST, 1"""),
    "hourly_pattern": _ON_EVENTS.format(keys="hour(ts)::INT AS order_hour", group="1")
    + " ORDER BY 1",
    "weekday_pattern": _ON_EVENTS.format(
        keys="dayname(ts) AS order_day, (dayofweek(ts) + 1)::INT AS order_day_num", group="1, 2"
    ) + " ORDER BY 2",
    "product_performance": _on_fact(_PRODUCT),
    "product_label": _on_fact(
        """SELECT product, category,
       CASE WHEN length(product) > 40 THEN left(product, 40) || '...' ELSE product END
         AS product_label,
       total_sales, total_profit FROM products""",
        f"products AS ({_PRODUCT})",
    ),
    "product_top10_sales": _on_fact(
        """SELECT product, category, total_sales, times_ordered, profit_margin FROM products
ORDER BY total_sales DESC NULLS LAST, product, category LIMIT 10""",
        f"products AS ({_PRODUCT})",
    ),
    "product_top10_profit": _on_fact(
        """SELECT product, category, total_profit, times_ordered, profit_margin FROM products
ORDER BY total_profit DESC NULLS LAST, product, category LIMIT 10""",
        f"products AS ({_PRODUCT})",
    ),
    "product_bottom10_sales": _on_fact(
        """SELECT product, category, total_sales, times_ordered FROM products
ORDER BY total_sales NULLS FIRST, product, category LIMIT 10""",
        f"products AS ({_PRODUCT})",
    ),
    "order_status_distribution": _on_fact(_STATUS + " ORDER BY 2 DESC NULLS LAST, 1"),
    "order_status_share": _on_fact(
        """SELECT status, order_count,
       round(order_count / sum(order_count) OVER () * 100, 1) AS share_pct FROM statuses""",
        f"statuses AS ({_STATUS})",
    ),
    "summary_statistics": _on_fact(f"""
SELECT count(*) AS total_records, count(DISTINCT order_id) AS total_orders,
       count(DISTINCT customer_id) AS total_customers, {_SALES} AS total_sales,
       {_MEAN_SALES} AS avg_sale, round(stddev_samp(fact.sales::DOUBLE), 6) AS stddev_sales,
       {_PROFIT} AS total_profit, {_MEAN_PROFIT} AS avg_profit,
       avg(late) AS avg_late_delivery_rate, avg(ship_real) AS avg_shipping_days
FROM fact"""),
    "category_summary": _on_fact(f"""
SELECT category, count(*) AS records, count(DISTINCT order_id) AS orders, {_SALES} AS sales,
       {_PROFIT} AS profit, {_MEAN_PROFIT} AS avg_profit_per_order,
       {_MARGIN} AS profit_margin_pct
FROM fact GROUP BY 1 ORDER BY 4 DESC NULLS LAST, 1"""),
    "correlation_matrix": _on_fact(_CORRELATIONS),
    "ml_dataset": _on_fact("SELECT * FROM dataset", _DATASET),
    "ml_split_counts": _on_fact(
        """SELECT CASE WHEN left(md5('42:' || order_id::VARCHAR), 8) < 'cccccccc'
            THEN 'train' ELSE 'test' END AS split, count(*) AS row_count
FROM dataset GROUP BY 1""",
        _DATASET,
    ),
    "ml_category_index": _on_fact(
        "\nUNION ALL ".join(
            f"SELECT '{feature}' AS feature, value, idx::DOUBLE AS category_index "
            f"FROM {feature}_index"
            for feature in ("ship_mode", "category", "region")
        ),
        _DATASET, *_INDEXES,
    ),
    "ml_features": _on_fact(
        f"""SELECT order_id, label, ship_real, ship_sched, sales,
       (3 + m.idx)::VARCHAR || ',' || (3 + {_MODES} + c.idx)::VARCHAR || ','
         || (3 + {_MODES} + {_CATEGORIES} + r.idx)::VARCHAR AS set_positions,
       (3 + {_MODES} + {_CATEGORIES} + {_REGIONS})::INT AS width
FROM dataset
JOIN ship_mode_index m ON ship_mode = m.value
JOIN category_index c ON category = c.value
JOIN region_index r ON region = r.value""",
        _DATASET, *_INDEXES,
    ),
    # The label follows from the days, so a model that sees both predicts every line away from the border.
    "ml_late_risk_predictions": _on_fact(
        f"""SELECT order_id, label, abs(ship_real - ship_sched) <= 7 AS at_border,
       CASE WHEN abs(ship_real - ship_sched) > 7 THEN (ship_real > ship_sched)::INT::DOUBLE END AS prediction
FROM dataset WHERE {_IS_TEST}""",
        _DATASET,
    ),
    # Area under the curve of the days of delay: rank sum of the late lines, equal scores sharing their mean rank.
    "ml_late_risk_auc": _on_fact(
        f"""SELECT 'areaUnderROC' AS metric, round((
         sum(CASE WHEN label = 1 THEN place END) - count(*) FILTER (WHERE label = 1)
           * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
       / (count(*) FILTER (WHERE label = 1)::DOUBLE * count(*) FILTER (WHERE label = 0)), 3)::DOUBLE AS value
FROM (
  SELECT label, rank() OVER (ORDER BY ship_real - ship_sched)
           + (count(*) OVER (PARTITION BY ship_real - ship_sched) - 1) / 2.0 AS place
  FROM dataset WHERE {_IS_TEST}
)""",
        _DATASET,
    ),
}
