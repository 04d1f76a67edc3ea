"""The KPI tables of the library.

To add one, add a ``Kpi`` here: keys, measures, and how to sort.  Where a name says
"orders" but the measure is ``rows()``, the value counts order lines; ``avg_order_value``
and ``avg_profit_per_order`` are means over lines as well.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from orderline_kpi.functions.columns import month_label, month_start, percent_of, weekday_label
from orderline_kpi.functions.measures import distinct, mean, rows, sample_deviation, total
from orderline_kpi.operators.kpi import Key, Kpi, Order


def _margin(profit: str, sales: str):
    return lambda: percent_of(F.col(profit), F.col(sales))


MONTHLY_TREND = Kpi(
    "monthly_trend",
    keys=(Key("order_month", "order_dt", group=month_start, label=month_label),),
    measures={
        "orders": distinct("order_id"),
        "sales": total("sales"),
        "profit": total("profit"),
        "late_rate": mean("late"),
    },
    order=(Order("order_month"),),
)

CATEGORY_CONTRIBUTION = Kpi(
    "category_contribution",
    keys=(Key("category"),),
    measures={
        "sales": total("sales"),
        "profit": total("profit"),
        "orders": distinct("order_id"),
    },
    order=(Order("sales", descending=True), Order("category")),
)

SHIPPING_MODE_PERFORMANCE = Kpi(
    "shipping_mode_performance",
    keys=(Key("ship_mode"),),
    measures={
        "total_orders": rows(),
        "late_rate": mean("late"),
        "avg_real_ship": mean("ship_real"),
        "avg_sched": mean("ship_sched"),
    },
    order=(Order("late_rate", descending=True), Order("ship_mode")),
)

REGIONAL_PERFORMANCE = Kpi(
    "regional_performance",
    keys=(Key("region"),),
    measures={
        "total_sales": total("sales"),
        "total_profit": total("profit"),
        "total_orders": distinct("order_id"),
        "avg_profit_per_order": mean("profit"),
        "late_delivery_rate": mean("late"),
    },
    derived={"profit_margin": _margin("total_profit", "total_sales")},
    order=(Order("total_sales", descending=True), Order("region")),
)

CUSTOMER_SEGMENT = Kpi(
    "customer_segment",
    keys=(Key("segment"),),
    measures={
        "total_orders": distinct("order_id"),
        "total_sales": total("sales"),
        "total_profit": total("profit"),
        "avg_order_value": mean("sales"),
        "avg_profit_per_order": mean("profit"),
    },
    order=(Order("total_sales", descending=True), Order("segment")),
)

HOURLY_PATTERN = Kpi(
    "hourly_pattern",
    keys=(Key("order_hour", "order_dt", group=F.hour),),
    measures={
        "order_count": rows(),
        "total_sales": total("sales"),
        "avg_sales": mean("sales"),
    },
    order=(Order("order_hour"),),
)

WEEKDAY_PATTERN = Kpi(
    "weekday_pattern",
    keys=(Key("order_day_num", "order_dt", group=F.dayofweek),),
    measures={
        "order_count": rows(),
        "total_sales": total("sales"),
        "avg_sales": mean("sales"),
    },
    derived={"order_day": lambda: weekday_label(F.col("order_day_num"))},
    order=(Order("order_day_num"),),
)

PRODUCT_PERFORMANCE = Kpi(
    "product_performance",
    keys=(Key("product"), Key("category")),
    measures={
        "times_ordered": rows(),
        "total_sales": total("sales"),
        "total_profit": total("profit"),
        "avg_sale_price": mean("sales"),
    },
    derived={"profit_margin": _margin("total_profit", "total_sales")},
)

ORDER_STATUS_DISTRIBUTION = Kpi(
    "order_status_distribution",
    keys=(Key("status"),),
    measures={
        "order_count": rows(),
        "total_sales": total("sales"),
        "total_profit": total("profit"),
        "avg_late_risk": mean("late"),
    },
    order=(Order("order_count", descending=True), Order("status")),
)

SUMMARY_STATISTICS = Kpi(
    "summary_statistics",
    keys=(),
    measures={
        "total_records": rows(),
        "total_orders": distinct("order_id"),
        "total_customers": distinct("customer_id"),
        "total_sales": total("sales"),
        "avg_sale": mean("sales"),
        "stddev_sales": sample_deviation("sales"),
        "total_profit": total("profit"),
        "avg_profit": mean("profit"),
        "avg_late_delivery_rate": mean("late"),
        "avg_shipping_days": mean("ship_real"),
    },
)

CATEGORY_SUMMARY = Kpi(
    "category_summary",
    keys=(Key("category"),),
    measures={
        "records": rows(),
        "orders": distinct("order_id"),
        "sales": total("sales"),
        "profit": total("profit"),
        "avg_profit_per_order": mean("profit"),
    },
    derived={"profit_margin_pct": _margin("profit", "sales")},
    order=(Order("sales", descending=True), Order("category")),
)

KPIS = {
    spec.name: spec
    for spec in (
        MONTHLY_TREND, CATEGORY_CONTRIBUTION, SHIPPING_MODE_PERFORMANCE,
        REGIONAL_PERFORMANCE, CUSTOMER_SEGMENT, HOURLY_PATTERN, WEEKDAY_PATTERN,
        PRODUCT_PERFORMANCE, ORDER_STATUS_DISTRIBUTION, SUMMARY_STATISTICS,
        CATEGORY_SUMMARY,
    )
}
