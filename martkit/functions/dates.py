"""Date and timestamp expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martkit.functions.text import as_col

# Fixed format of window bounds handed to the activity endpoint.
API_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def julian_key(d) -> Column:
    """Date key ``year * 1000 + day of year`` (e.g. 2024-02-01 -> 2024032)."""
    d = as_col(d)
    return (F.year(d) * F.lit(1000) + F.dayofyear(d)).cast("int")


def yyyymmdd(d) -> Column:
    """Compact day text ``YYYYMMDD`` used for dated folders."""
    return F.date_format(as_col(d), "yyyyMMdd")


def ts_text(ts, quoted: bool = False) -> Column:
    """Timestamp as ``YYYY-MM-DDTHH:MM:SSZ``; ``quoted`` wraps it in single
    quotes the way the endpoint parameters were stored."""
    t = F.date_format(as_col(ts), API_TS_FORMAT)
    return F.concat(F.lit("'"), t, F.lit("'")) if quoted else t
