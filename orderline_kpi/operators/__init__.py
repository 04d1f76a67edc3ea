"""Analyses: each takes a DataFrame of order lines and returns a lazy DataFrame."""

from orderline_kpi.operators.cleaning import clean, preview
from orderline_kpi.operators.correlation import correlation_matrix
from orderline_kpi.operators.kpi import Key, Kpi, Order, kpi
from orderline_kpi.operators.late_risk import (
    LateRisk, fit_features, late_risk_dataset, train_late_risk,
)
from orderline_kpi.operators.ranking import ranked, with_label
from orderline_kpi.operators.shares import bubble_feed, shares, shipping_days_series

__all__ = [
    "Key", "Kpi", "LateRisk", "Order", "bubble_feed", "clean", "correlation_matrix",
    "fit_features", "kpi", "late_risk_dataset", "preview", "ranked", "shares",
    "shipping_days_series", "train_late_risk", "with_label",
]
