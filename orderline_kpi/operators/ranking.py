"""Top and bottom lists of a KPI table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from orderline_kpi.functions.columns import short_label
from orderline_kpi.operators.kpi import Order


def ranked(
    table: DataFrame, by: Order, ties: Sequence[str] = (), n: int = 10,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The first ``n`` rows by one column; rows that tie are taken in order of ``ties``.

    Each task keeps its own best ``n``, so there is no full sort.
    """
    order = [by, *(Order(column) for column in ties)]
    top = table.orderBy(*[o.build() for o in order]).limit(n)
    return top.select(*columns) if columns else top


def with_label(table: DataFrame, column: str, label: str) -> DataFrame:
    """Add a short form of a text column, for use on a chart axis."""
    return table.withColumn(label, short_label(F.col(column)))
