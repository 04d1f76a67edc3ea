"""Aggregates over order lines.

A ``Measure`` names its input column, so that an analysis knows which columns it
reads before any plan exists.

Totals come back as double.  Over a decimal column the addition itself is exact and
does not depend on the order in which partial sums arrive, so a retried task cannot
change a result; over a double column it is Spark's own double sum.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Measure:
    column: str | None
    aggregate: Callable[[Column | None], Column]
    is_distinct: bool = False

    def build(self) -> Column:
        return self.aggregate(None if self.column is None else F.col(self.column))


def rows() -> Measure:
    """Number of order lines (not of orders)."""
    return Measure(None, lambda _: F.count("*"))


def distinct(column: str) -> Measure:
    """Exact number of different non-null values."""
    return Measure(column, F.countDistinct, is_distinct=True)


def total(column: str) -> Measure:
    return Measure(column, lambda c: F.sum(c).cast("double"))


def mean(column: str) -> Measure:
    """Mean over the lines where the column is not null; null if there are none.

    Written as total over count because ``avg`` of a decimal is cut to a fixed scale.
    """
    return Measure(column, lambda c: F.try_divide(F.sum(c).cast("double"), F.count(c)))


def sample_deviation(column: str) -> Measure:
    """Sample standard deviation; null for a single line."""
    return Measure(column, F.stddev_samp)
