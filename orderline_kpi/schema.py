"""Column names and types of the order-line data.

One row is one order line.  ``RAW_COLUMNS`` describes the CSV headers the library
knows and the snake_case name each gets after cleaning; every other CSV column is
carried along under its own name.  Ids are text: whatever the file has as an id stays one.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, types as T


@dataclass(frozen=True)
class RawColumn:
    header: str
    name: str
    data_type: T.DataType


# CSV headers and text formats as they stand in the input files.
RAW_COLUMNS = (
    RawColumn("order date (DateOrders)", "order_date_text", T.StringType()),
    RawColumn("shipping date (DateOrders)", "ship_date_text", T.StringType()),
    RawColumn("Sales", "sales", T.DoubleType()),
    RawColumn("Order Profit Per Order", "profit", T.DoubleType()),
    RawColumn("Late_delivery_risk", "late", T.DoubleType()),
    RawColumn("Days for shipping (real)", "ship_real", T.DoubleType()),
    RawColumn("Days for shipment (scheduled)", "ship_sched", T.DoubleType()),
    RawColumn("Order Id", "order_id", T.StringType()),
    RawColumn("Customer Id", "customer_id", T.StringType()),
    RawColumn("Category Name", "category", T.StringType()),
    RawColumn("Shipping Mode", "ship_mode", T.StringType()),
    RawColumn("Order Region", "region", T.StringType()),
    RawColumn("Customer Segment", "segment", T.StringType()),
    RawColumn("Product Name", "product", T.StringType()),
    RawColumn("Order Status", "status", T.StringType()),
)
RAW_ENCODING = "ISO-8859-1"
RAW_DATE_FORMAT = "M/d/yyyy H:mm"

# Text column -> timestamp column that cleaning derives from it.
DATE_COLUMNS = {"order_date_text": "order_dt", "ship_date_text": "ship_dt"}

NUMERIC_COLUMNS = ("sales", "profit", "late", "ship_real", "ship_sched")

_BY_HEADER = {column.header.casefold(): column for column in RAW_COLUMNS}


def raw_column(header: str) -> RawColumn | None:
    """The known column behind a CSV header, ignoring case; None for any other."""
    return _BY_HEADER.get(header.casefold())


def raw_schema(headers: Iterable[str]) -> T.StructType:
    """Schema for a CSV with these headers, in this order.

    CSV columns are bound by position, so the schema must follow the file: known
    columns get their type, all others are read as text.
    """
    fields = []
    for header in headers:
        known = raw_column(header)
        fields.append(T.StructField(header, known.data_type if known else T.StringType()))
    return T.StructType(fields)


class MissingColumnsError(ValueError):
    """An analysis was asked for on a table that lacks columns it needs."""

    def __init__(self, analysis: str, columns: Iterable[str]):
        self.analysis = analysis
        self.columns = tuple(columns)
        super().__init__(f"{analysis} needs missing column(s): {', '.join(self.columns)}")


def require_columns(df: DataFrame, columns: Iterable[str], analysis: str) -> None:
    missing = [column for column in columns if column not in df.columns]
    if missing:
        raise MissingColumnsError(analysis, missing)
