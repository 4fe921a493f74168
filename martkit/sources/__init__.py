"""Sources and sinks."""

from martkit.sources.json_pages import (
    explode_envelope, from_json_col, pages_until_error, read_envelope, union_pages,
)
from martkit.sources.page_links import follow_links
from martkit.sources.sinks import staging_name, write_by_load_date, write_if_any, write_parquet
from martkit.sources.tables import date_dimension, load
from martkit.sources.windows import assign_day_window, day_windows, window_texts
from martkit.sources.selection import details_for


__all__ = [
    "explode_envelope", "from_json_col", "pages_until_error", "read_envelope", "union_pages",
    "staging_name", "write_by_load_date", "write_if_any", "write_parquet", "date_dimension",
    "load", "assign_day_window", "day_windows", "window_texts", "details_for", "follow_links",
]
