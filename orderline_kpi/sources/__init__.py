"""Reading and writing order-line data."""

from orderline_kpi.sources.curated import read_curated, write_curated
from orderline_kpi.sources.raw_csv import profile, read_raw, schema_table, stage_raw
from orderline_kpi.sources.scratch import materialize, scratch_path
from orderline_kpi.sources.star import event_lines, order_lines

__all__ = [
    "event_lines", "materialize", "order_lines", "profile", "read_curated", "read_raw",
    "schema_table", "scratch_path", "stage_raw", "write_curated",
]
