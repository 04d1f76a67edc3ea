"""Order-line KPI analytics on Spark."""

from orderline_kpi.operators import (
    Key, Kpi, LateRisk, Order, bubble_feed, clean, correlation_matrix, fit_features, kpi,
    late_risk_dataset, preview, ranked, shares, shipping_days_series,
    train_late_risk, with_label,
)
from orderline_kpi.plans.catalog import KPIS
from orderline_kpi.plans.pipeline import run_pipeline
from orderline_kpi.plans.reports import Reports, run_all
from orderline_kpi.plans.settings import configure
from orderline_kpi.schema import MissingColumnsError
from orderline_kpi.sources import profile, read_curated, read_raw, schema_table, write_curated

__all__ = [
    "KPIS", "Key", "Kpi", "LateRisk", "MissingColumnsError", "Order", "Reports",
    "bubble_feed", "clean", "configure", "correlation_matrix", "fit_features", "kpi", "late_risk_dataset",
    "preview", "profile", "ranked", "read_curated", "read_raw", "run_all", "run_pipeline",
    "schema_table", "shares", "shipping_days_series",
    "train_late_risk", "with_label", "write_curated",
]
