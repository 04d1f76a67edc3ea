"""All analyses by name: KPI tables, what is derived from them, and the rest."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from orderline_kpi.operators.correlation import correlation_matrix
from orderline_kpi.operators.kpi import Order, kpi
from orderline_kpi.operators.late_risk import LateRisk
from orderline_kpi.operators.ranking import ranked, with_label
from orderline_kpi.operators.shares import bubble_feed, shares, shipping_days_series
from orderline_kpi.plans.catalog import KPIS
from orderline_kpi.schema import MissingColumnsError


def _base(name: str) -> Callable[[DataFrame], DataFrame]:
    # The lines of a batch are stored, so a second narrow scan is cheaper than wider shuffles.
    return lambda lines: kpi(lines, KPIS[name], separate_distinct=True)


# Analyses of order lines.
BASE: dict[str, Callable[[DataFrame], DataFrame]] = {
    name: _base(name) for name in KPIS
} | {
    "correlation_matrix": correlation_matrix,
}

_PRODUCT = ("product", "category")

# Reports on one finished KPI table.
DERIVED: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "monthly_first12": (
        "monthly_trend", lambda table: ranked(table, Order("order_month"), n=12),
    ),
    "category_top10": (
        "category_contribution",
        lambda table: ranked(table, Order("sales", descending=True), ["category"]),
    ),
    "shipping_days_series": ("shipping_mode_performance", shipping_days_series),
    "regional_sales_share": (
        "regional_performance", lambda table: shares(table, "region", "total_sales"),
    ),
    "regional_bubble": ("regional_performance", bubble_feed),
    "product_label": (
        "product_performance",
        lambda table: with_label(table, "product", "product_label").select(
            *_PRODUCT, "product_label", "total_sales", "total_profit"
        ),
    ),
    "product_top10_sales": (
        "product_performance",
        lambda table: ranked(
            table, Order("total_sales", descending=True), _PRODUCT,
            columns=[*_PRODUCT, "total_sales", "times_ordered", "profit_margin"],
        ),
    ),
    "product_top10_profit": (
        "product_performance",
        lambda table: ranked(
            table, Order("total_profit", descending=True), _PRODUCT,
            columns=[*_PRODUCT, "total_profit", "times_ordered", "profit_margin"],
        ),
    ),
    "product_bottom10_sales": (
        "product_performance",
        lambda table: ranked(
            table, Order("total_sales"), _PRODUCT,
            columns=[*_PRODUCT, "total_sales", "times_ordered"],
        ),
    ),
    "order_status_share": (
        "order_status_distribution", lambda table: shares(table, "status", "order_count"),
    ),
}


@dataclass
class Reports:
    """Result tables by name, the analyses left out with the reason, and the fitted model if there is one."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    skipped: dict[str, str] = field(default_factory=dict)
    model: LateRisk | None = None

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.tables)


def run_all(
    lines: DataFrame, keep: Callable[[str, DataFrame], DataFrame] = lambda name, table: table
) -> Reports:
    """Every analysis these order lines have the columns for.

    ``keep`` may store a finished KPI table and return the stored one, so that the
    reports derived from it do not aggregate the lines again.
    """
    reports = Reports()
    for name, analysis in BASE.items():
        try:
            reports.tables[name] = keep(name, analysis(lines))
        except MissingColumnsError as missing:
            reports.skipped[name] = str(missing)
    for name, (source, report) in DERIVED.items():
        if source in reports.tables:
            reports.tables[name] = report(reports.tables[source])
        else:
            reports.skipped[name] = reports.skipped[source]
    return reports
