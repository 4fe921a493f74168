"""Column-expression helpers (all JVM-side, no Python UDFs)."""

from martkit.functions.text import (
    as_col, bracket, concat_blank, concat_strict, left_of_number, lpad_number,
    underscore_spaces,
)
from martkit.functions.numbers import div0, hundredths, period_id, to_cents
from martkit.functions.dates import julian_key, ts_text, yyyymmdd

__all__ = [
    "as_col", "bracket", "concat_blank", "concat_strict", "left_of_number",
    "lpad_number", "underscore_spaces", "div0", "hundredths", "period_id",
    "to_cents", "julian_key", "ts_text", "yyyymmdd",
]
