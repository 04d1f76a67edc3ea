"""Grouped KPI tables, declared as data and planned by one function."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from orderline_kpi.functions.measures import Measure
from orderline_kpi.schema import require_columns


@dataclass(frozen=True)
class Key:
    """A grouping column.

    ``group`` turns the source column into the value to group by.  ``label`` turns that
    value into the one to show; it runs once per group instead of once per line.
    """

    name: str
    source: str | None = None
    group: Callable[[Column], Column] | None = None
    label: Callable[[Column], Column] | None = None

    @property
    def column(self) -> str:
        return self.source or self.name

    def build(self) -> Column:
        value = F.col(self.column)
        return (self.group(value) if self.group else value).alias(self.name)


@dataclass(frozen=True)
class Order:
    column: str
    descending: bool = False

    def build(self) -> Column:
        """Nulls come first when ascending and last when descending."""
        if self.descending:
            return F.desc_nulls_last(self.column)
        return F.asc_nulls_first(self.column)


@dataclass(frozen=True)
class Kpi:
    name: str
    keys: tuple[Key, ...]
    measures: Mapping[str, Measure]
    derived: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    order: tuple[Order, ...] = ()

    @property
    def key_columns(self) -> tuple[str, ...]:
        return tuple(key.column for key in self.keys)

    @property
    def plain_inputs(self) -> tuple[str, ...]:
        """The order-line columns read for all but the distinct counts."""
        columns = list(self.key_columns)
        columns += [
            measure.column for measure in self.measures.values()
            if measure.column and not measure.is_distinct
        ]
        return tuple(dict.fromkeys(columns))

    @property
    def distinct_measures(self) -> dict[str, list[str]]:
        """Counted column -> names of the measures that count it."""
        counted: dict[str, list[str]] = {}
        for name, measure in self.measures.items():
            if measure.is_distinct:
                counted.setdefault(measure.column, []).append(name)
        return counted


def _aggregate(lines: DataFrame, spec: Kpi, names: Iterable[str]) -> DataFrame:
    return lines.groupBy(*[key.build() for key in spec.keys]).agg(
        *[spec.measures[name].build().alias(name) for name in names]
    )


def kpi(lines: DataFrame, spec: Kpi, separate_distinct: bool = False) -> DataFrame:
    """The KPI table of ``spec`` over these order lines, in one pass.

    Lines are combined before the shuffle, so what moves is one row per task and group,
    however many lines a group holds; with an exact distinct count it is one for each value counted.

    ``separate_distinct=True`` gives every counted column an aggregation of its own over just the
    keys and that column, so that the other measures do not travel with each value and two counts
    do not multiply the rows.  That reads ``lines`` once more per count: for stored tables, not for plans
    that join or parse.
    """
    plain = [name for name, measure in spec.measures.items() if not measure.is_distinct]
    require_columns(lines, [*spec.plain_inputs, *spec.distinct_measures], spec.name)
    if separate_distinct and spec.distinct_measures:
        groups = ([plain] if plain else []) + list(spec.distinct_measures.values())
        # Each group has one row in every table; a null in the others fills up.
        table = reduce(
            lambda a, b: a.unionByName(b, allowMissingColumns=True), [_aggregate(lines, spec, names) for names in groups])
        table = table.groupBy(*[key.name for key in spec.keys]).agg(
            *[F.max(name).alias(name) for name in spec.measures]
        )
    else:
        table = _aggregate(lines, spec, spec.measures)
    shown = {name: column() for name, column in spec.derived.items()}
    shown |= {key.name: key.label(F.col(key.name)) for key in spec.keys if key.label}
    if shown:
        table = table.withColumns(shown)
    if spec.order:
        table = table.orderBy(*[order.build() for order in spec.order])
    return table
