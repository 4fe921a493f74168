"""Text expressions with explicit NULL rules.

Two CONCAT flavours exist in warehouse SQL and both are needed:

* ``concat_strict``: any NULL input makes the result NULL (``a || b``, or
  ``'x' + col`` in T-SQL).
* ``concat_blank``: NULL inputs count as empty text (T-SQL ``CONCAT``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_col(c) -> Column:
    """Column from a column name or a Column; other values become literals."""
    if isinstance(c, Column):
        return c
    if isinstance(c, str):
        return F.col(c)
    return F.lit(c)


def _lit_or_col(c) -> Column:
    # Plain strings here are text pieces, not column names.
    return c if isinstance(c, Column) else F.lit(c)


def concat_strict(*parts) -> Column:
    """NULL in, NULL out.  Strings are literals; pass Columns for columns."""
    return F.concat(*[_lit_or_col(p).cast("string") for p in parts])


def concat_blank(*parts) -> Column:
    """NULL counts as ''.  Strings are literals; pass Columns for columns."""
    return F.concat(*[F.coalesce(_lit_or_col(p).cast("string"), F.lit("")) for p in parts])


def bracket(c) -> Column:
    """``[name]`` quoting; NULL stays NULL."""
    return concat_strict("[", as_col(c), "]")


def underscore_spaces(c) -> Column:
    """Every space becomes an underscore."""
    return F.replace(as_col(c).cast("string"), F.lit(" "), F.lit("_"))


def lpad_number(c, width: int, fill: str = "0") -> Column:
    """Left-pad the text form of a number (``LPAD(12, 2, '0')`` gives ``'12'``)."""
    return F.lpad(as_col(c).cast("bigint").cast("string"), width, fill)


def left_of_number(c, n: int) -> Column:
    """First ``n`` characters of a whole number's text (casts through bigint so
    a double such as 202301.0 cannot leak its decimal point)."""
    return F.substring(as_col(c).cast("bigint").cast("string"), 1, n)


def fold_case(c) -> Column:
    """Text that is equal for names that differ in case only, as ``UTF8_LCASE`` compares them: lower case, with the
    two small sigmas as one. Plain text: Spark joins, groups and sorts it like any other key."""
    return F.replace(F.lower(as_col(c)), F.lit("\u03c2"), F.lit("\u03c3"))


def without_case(df: DataFrame, shown: Sequence[str] = (), late: Sequence[str] = (), suffix: str = "_shown") -> DataFrame:
    """Text columns in folded case; those in ``shown`` also with their spelling, as ``<name><suffix>``, and those in
    ``late`` with their spelling only, to be folded where they are compared."""
    return df.select(*[fold_case(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
                       for f in df.schema.fields if f.name not in late],
                     *[F.col(name).alias(f"{name}{suffix}") for name in [*shown, *late]])
