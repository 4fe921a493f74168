"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martkit.functions.text import as_col


def div0(a, b) -> Column:
    """Warehouse ``DIV0``: 0 when the divisor is 0, NULL when it is NULL.

    Unlike ``try_divide`` (NULL on zero).  The CASE guards the division so
    ANSI mode never sees a zero divisor.
    """
    a, b = as_col(a), as_col(b)
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def hundredths(c) -> Column:
    """Amount stored in hundredths to units (``x / 100``)."""
    return as_col(c) / F.lit(100)


def to_cents(c) -> Column:
    """Double money to exact bigint cents, so sums do not depend on order."""
    return F.round(as_col(c) * F.lit(100)).cast("bigint")


def period_id(year, month) -> Column:
    """``year * 100 + month`` from text or numbers, as bigint."""
    return as_col(year).cast("bigint") * F.lit(100) + as_col(month).cast("bigint")
