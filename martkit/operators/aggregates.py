"""Grouped aggregates: grain reduction and ordered text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_nonzero(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """``SUM(value) GROUP BY keys HAVING SUM(value) <> 0`` (partial agg map-side)."""
    return df.groupBy(*keys).agg(F.sum(value).alias(name)).filter(F.col(name) != 0)


def sql_text(s: str) -> str:
    """Spark SQL string literal for ``s``."""
    esc = (s.replace("\\", "\\\\").replace("'", "\\'")
           .replace("\n", "\\n").replace("\t", "\\t").replace("\r", "\\r"))
    return f"'{esc}'"


def ordered_text_agg(item_col: str, order_cols: list[str], sep: str) -> Column:
    """``STRING_AGG(item, sep) WITHIN GROUP (ORDER BY order_cols)``.

    Aggregate expression over existing columns.  Skips NULL items; a group
    of only NULL items gives NULL; NULL order keys sort first.  Give enough
    order columns to make the order unique.
    """
    order_sql = ", ".join(f"`{c}` ASC NULLS FIRST" for c in order_cols)
    return F.expr(f"listagg(`{item_col}`, {sql_text(sep)}) WITHIN GROUP (ORDER BY {order_sql})")


def group_ordered_texts(df: DataFrame, keys: list[str], texts: dict[str, tuple[Column, str]], order: list[Column],
                        chunk: Column, sums: dict[str, Column] | None = None,
                        maxes: dict[str, Column] | None = None, compared: dict[str, Column] | None = None) -> DataFrame:
    """One row per key with ordered texts: ``texts`` = {name: (item, separator)}.

    ``chunk`` is a bucket that never decreases along ``order`` (e.g. ranges of
    the first order column). Rows are hash-partitioned by (key, chunk) and each
    chunk's texts are built on their own; then a key's chunks are joined in
    order. So a key with many rows is spread over as many tasks as it has
    chunks, and only chunk texts meet. A collecting aggregate shrinks nothing
    map-side, so there is no partial step before either shuffle, and items are
    built after it: rows move with the columns that these are built from.
    ``sums`` and ``maxes`` = {name: Column} are added up, or their largest kept,
    along the way. ``compared`` = {key: Column over it}: such keys are equal where
    that is equal; the greatest of the equal ones is returned.
    """
    sums, maxes, compared = sums or {}, maxes or {}, compared or {}
    by = {f"_by_{k}" if k in compared else k: compared.get(k, F.col(k)) for k in keys}
    alike = [b.alias(k) for k, b in by.items()]
    others = [F.sum(n).alias(n) for n in sums] + [F.max(n).alias(n) for n in [*maxes, *compared]]
    order_cols = [f"_o{i}" for i in range(len(order))]
    staged = df.repartition(*by.values(), chunk).select(
        *alike, *compared, chunk.alias("_chunk"),
        *[o.alias(c) for o, c in zip(order, order_cols)],
        *[item.alias(f"_i_{n}") for n, (item, _) in texts.items()],
        *[value.alias(n) for n, value in (sums | maxes).items()])
    chunks = staged.groupBy(*by, "_chunk").agg(
        *[ordered_text_agg(f"_i_{n}", order_cols, sep).alias(n) for n, (_, sep) in texts.items()],
        *others)
    names = ["_chunk", *texts, *sums, *maxes]
    moved = chunks.select(*keys, *names).repartition(*by.values()).select(*alike, *compared, *names)
    return moved.groupBy(*by).agg(
        *[ordered_text_agg(n, ["_chunk"], sep).alias(n) for n, (_, sep) in texts.items()],
        *others).select(*keys, *texts, *sums, *maxes)


def group_ordered_text(df: DataFrame, keys: list[str], item: Column, order: list[Column], sep: str, name: str,
                       chunk: Column) -> DataFrame:
    """:func:`group_ordered_texts` for one text."""
    return group_ordered_texts(df, keys, {name: (item, sep)}, order, chunk)
