"""Scalar column builders shared by the analyses."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, functions as F

_A_SUNDAY = datetime.date(2023, 1, 1)


def month_start(timestamp: Column) -> Column:
    return F.trunc(timestamp, "MM")


def month_label(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM")


def weekday_label(day_number: Column) -> Column:
    """Full weekday name of a ``dayofweek`` number (1 = Sunday)."""
    return F.date_format(F.date_add(F.lit(_A_SUNDAY), day_number - 1), "EEEE")


def percent_of(part: Column, whole: Column) -> Column:
    """part / whole * 100; null where whole is 0."""
    return F.try_divide(part, whole) * 100


def short_label(text: Column, width: int = 40) -> Column:
    """The text itself up to ``width`` characters, else its start and three dots."""
    return F.when(
        F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))
    ).otherwise(text)
