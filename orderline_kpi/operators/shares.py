"""What charts are drawn from: shares of a total and series, out of KPI tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderline_kpi.functions.columns import percent_of


def shares(table: DataFrame, key: str, value: str, name: str = "share_pct") -> DataFrame:
    """Each group's part of the grand total in percent, to one decimal.

    The total is a scalar subquery, so no task has to hold the table.
    """
    whole = table.agg(F.sum(value)).scalar()
    return table.select(
        key, value, F.round(percent_of(F.col(value), whole), 1).alias(name)
    )


def bubble_feed(regional: DataFrame) -> DataFrame:
    """Orders against lateness per region, with bubble size and colour."""
    return regional.select(
        "region", "total_orders", "late_delivery_rate",
        (F.col("total_sales") / F.lit(10000)).alias("bubble_size"),
        "profit_margin",
    )


def shipping_days_series(shipping: DataFrame) -> DataFrame:
    """Actual and scheduled days of each shipping mode as two rows."""
    return shipping.select(
        "ship_mode",
        F.col("avg_real_ship").alias("Actual"),
        F.col("avg_sched").alias("Scheduled"),
    ).unpivot("ship_mode", ["Actual", "Scheduled"], "series", "days")
