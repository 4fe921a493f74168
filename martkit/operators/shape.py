"""Column shaping: unpivot, flatten, name cleaning, strict projection."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unpivot_columns(df: DataFrame, value_cols: list[str], keep: list[str],
                    index_name: str = "fiscal_month", value_name: str = "amount",
                    divisor: float | int | None = 100, index_as_text: bool = True,
                    only: Column | None = None) -> DataFrame:
    """Wide period columns to long rows, one row per column, always.

    ``posexplode`` keeps NULL elements, so every input row yields exactly
    ``len(value_cols)`` rows (SQL ``UNPIVOT`` would drop NULL months).  The
    index is 1-based; as text by default, the way the ledger view keys it.
    Runs as a ``Generate`` node: no shuffle. ``only``: an array of the indexes
    that a row gives rows for, NULL for all of them.
    """
    vals = [F.col(c) / F.lit(divisor) if divisor else F.col(c) for c in value_cols]
    if only is not None:
        every = F.array(*[F.lit(i + 1) for i in range(len(vals))])
        out = df.select(*keep, *value_cols, F.explode(F.coalesce(only, every)).alias("_at"))
        at = F.col("_at")
        value = F.when(at == 1, vals[0].cast("double"))
        for i, v in enumerate(vals[1:], 2):
            value = value.when(at == i, v.cast("double"))
        return out.select(*keep, at.cast("string" if index_as_text else "int").alias(index_name), value.alias(value_name))
    out = df.select(*[F.col(c) for c in keep],
                    F.posexplode(F.array(*[v.cast("double") for v in vals])).alias("_pos", value_name))
    idx = F.col("_pos") + F.lit(1)
    idx = idx.cast("string") if index_as_text else idx.cast("int")
    return out.select(*keep, idx.alias(index_name), value_name)


def flatten_structs(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested objects become top-level columns ``parent<sep>child`` at any
    depth; arrays stay arrays.  One ``select``; the walk is over the schema
    on the driver only."""
    cols = []

    def walk(dtype: T.DataType, path: list[str]):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(f.dataType, path + [f.name])
        else:
            c = F.col(".".join(f"`{p}`" for p in path))
            cols.append(c.alias(sep.join(path)))

    for f in df.schema.fields:
        walk(f.dataType, [f.name])
    return df.select(*cols)


_NON_WORD = re.compile(r"[^\w]")


def clean_name(name: str) -> str:
    """Every non-word character becomes ``_``.  Python's ``\\w`` keeps
    letters such as ``é``, matching the original pandas rule."""
    return _NON_WORD.sub("_", name)


def clean_column_names(df: DataFrame) -> DataFrame:
    """Rename all columns with :func:`clean_name`; raise if two collide
    (Spark compares names case-insensitively)."""
    new = [clean_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        k = n.lower()
        if k in seen:
            raise ValueError(f"cleaned column names collide: {seen[k]!r} and {old!r} -> {n!r}")
        seen[k] = old
    return df.toDF(*new)


def strict_select(df: DataFrame, names: list[str]) -> DataFrame:
    """Project exactly ``names``; raise listing every missing one."""
    have = set(df.columns)
    missing = [n for n in names if n not in have]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[F.col(f"`{n}`") for n in names])


def with_literals(df: DataFrame, **values) -> DataFrame:
    """Append constant columns (``None`` becomes a NULL string column)."""
    return df.withColumns({k: (F.lit(v) if v is not None else F.lit(None).cast("string"))
                           for k, v in values.items()})


def stamp_load_date(df: DataFrame, run_ts, name: str = "ETLImportDate") -> DataFrame:
    """Load-date stamp ``YYYY-MM-DD`` as text, from the injected run time."""
    return df.withColumn(name, F.lit(run_ts.strftime("%Y-%m-%d")))


def as_view(df: DataFrame, names: list[str], view_name: str | None = None) -> DataFrame:
    """Positional output names (a view's column list); optionally register."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    out = df.toDF(*names)
    if view_name:
        out.createOrReplaceTempView(view_name)
    return out
