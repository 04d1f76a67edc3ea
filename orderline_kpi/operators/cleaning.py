"""From the raw CSV to typed order lines."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F

from orderline_kpi.schema import (
    DATE_COLUMNS, NUMERIC_COLUMNS, RAW_DATE_FORMAT, raw_column, require_columns,
)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def clean(raw: DataFrame) -> DataFrame:
    """Rename known columns, parse the dates and cast the numbers.

    Text that is no date or no number becomes null; no row is dropped.  Columns the
    library does not know keep their name and type.
    """
    columns: dict[str, Column] = {}
    names = []
    for header in raw.columns:
        known = raw_column(header)
        name = known.name if known else header
        value = _quoted(header)
        if name in NUMERIC_COLUMNS:
            value = value.try_cast("double")
        columns[name] = value.alias(name)
        names.append(name)
    for text, timestamp in DATE_COLUMNS.items():
        if text in columns:
            columns[timestamp] = F.try_to_timestamp(
                columns[text], F.lit(RAW_DATE_FORMAT)
            ).alias(timestamp)
            names.append(timestamp)
    clashes = [name for name, n in Counter(name.casefold() for name in names).items() if n > 1]
    if clashes:
        raise ValueError(f"more than one column would be called: {', '.join(clashes)}")
    return raw.select(list(columns.values()))


def preview(lines: DataFrame, n: int = 5, ordered: bool = False) -> DataFrame:
    """A few cleaned lines: any, or, after a look at all of them, always the same first ones."""
    columns = ["order_dt", "sales", "profit", "late"]
    require_columns(lines, columns, "preview")
    shown = lines.select(columns)
    if ordered:
        shown = shown.orderBy(*[F.asc_nulls_first(column) for column in columns])
    return shown.limit(n)
