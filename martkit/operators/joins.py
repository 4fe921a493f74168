"""Lookups and joins with warehouse semantics.

Scale rules followed here:

* Nothing here asks for a broadcast: Spark decides from real sizes, at
  planning time and again at run time (AQE).
* "One best row per key" and "count per key" are aggregates, not window
  functions, so a key holding a third of all rows is combined map-side
  instead of landing whole in one task.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkit.functions.text import as_col

_uid = itertools.count()

def left_lookup(df: DataFrame, right: DataFrame, on: Sequence[tuple], take: dict[str, str],
                right_filter: Column | None = None, null_safe: bool = False) -> DataFrame:
    """Left join ``right`` and add ``take`` = {new_name: right_column}.

    ``on`` pairs a left expression (column name or Column, e.g. a
    ``trim``) with a right column name.  ``right_filter`` restricts the
    right side *before* the join, which gives the same rows as putting the
    right-only conditions inside ``ON`` of a left join (misses stay NULL).
    Right columns are renamed to private names, so the same table can be
    joined several times.
    """
    tag = f"_r{next(_uid)}"
    r = right if right_filter is None else right.filter(right_filter)
    keys = [f"{tag}_k{i}" for i in range(len(on))]
    r = r.select(*[F.col(rc).alias(k) for (_, rc), k in zip(on, keys)],
                 *[F.col(src).alias(f"{tag}_{new}") for new, src in take.items()])
    cond = None
    for (lc, _), k in zip(on, keys):
        le = as_col(lc)
        c = le.eqNullSafe(F.col(k)) if null_safe else le == F.col(k)
        cond = c if cond is None else cond & c
    out = df.join(r, cond, "left").drop(*keys)
    return out.withColumnsRenamed({f"{tag}_{new}": new for new in take})


def best_row_per_key(df: DataFrame, keys: list[str], order: list[Column], payload: list[str]) -> DataFrame:
    """One row per key: the first by ``order``, carrying ``payload`` columns.

    Plain columns sort ascending, NULL first, and run as a partial aggregate
    (``min`` of a struct). If any of them has a direction (``.desc()`` and the
    like), the row comes from ``row_number() = 1``, where Spark keeps one row
    per key in each task before the shuffle (``WindowGroupLimit``). Both give
    the same row when the order is unique.
    """
    if any(re.search(r" (ASC|DESC) NULLS (FIRST|LAST)'?>?$", str(o)) for o in order):
        first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        kept = df.select(*keys, *payload, first.alias("_first")).filter(F.col("_first") == 1)
        return kept.select(*keys, *payload)
    fields = [o.alias(f"_o{i}") for i, o in enumerate(order)] + [F.col(p).alias(p) for p in payload]
    best = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{p}").alias(p) for p in payload])


def count_per_key(df: DataFrame, keys: list[str], counted: Column, name: str) -> DataFrame:
    """``count(counted) over (partition by keys)`` as aggregate + join back.

    The counts are one row per key (combined map-side, so a hot key is
    never buffered whole the way a window partition is); the join back is
    null-safe so NULL keys form one group, as in a window partition.  The
    input is evaluated by both branches: give it a cheap input (a scan or
    a short chain), not the end of a long join chain.
    """
    tag = f"_c{next(_uid)}"
    counts = (df.groupBy(*[F.col(k).alias(f"{tag}_{k}") for k in keys])
              .agg(F.count(counted).alias(name)))
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(F.col(f"{tag}_{k}"))
        cond = c if cond is None else cond & c
    return df.join(counts, cond, "left").drop(*[f"{tag}_{k}" for k in keys])


def left_join_distinct(left: DataFrame, right: DataFrame, on: Sequence[tuple], take: dict[str, str],
                       out_cols: list[str]) -> DataFrame:
    """Left join then collapse duplicate rows (``GROUP BY`` every column).

    The right side is reduced to distinct (keys, taken columns) first, so
    the join moves one row per distinct pair instead of every match.
    """
    rcols = list(dict.fromkeys([rc for _, rc in on] + list(take.values())))
    r = right.select(*rcols).distinct()
    return left_lookup(left, r, on, take).select(*out_cols).distinct()


def tiered_lookup(df: DataFrame, levels: Sequence[tuple], name: str) -> DataFrame:
    """First non-NULL value over lookup levels, most specific first.

    ``levels``: ``(right, on, value_col, right_filter)``.  Each level is a
    left lookup; the result is ``coalesce`` over the levels.
    """
    tmp = []
    for i, (right, on, value_col, rf) in enumerate(levels):
        col_name = f"_{name}_lvl{i}"
        df = left_lookup(df, right, on, {col_name: value_col}, right_filter=rf)
        tmp.append(col_name)
    return df.withColumn(name, F.coalesce(*[F.col(c) for c in tmp])).drop(*tmp)


def listed_flag(df: DataFrame, levels: Sequence[tuple], name: str) -> DataFrame:
    """0/1 flag: 1 when any block-list level has a matching entry.

    ``levels``: ``(right, on, marker_col, right_filter)``.  An empty block
    list gives 0 everywhere.
    """
    tmp = []
    for i, (right, on, marker, rf) in enumerate(levels):
        col_name = f"_{name}_lvl{i}"
        df = left_lookup(df, right, on, {col_name: marker}, right_filter=rf)
        tmp.append(col_name)
    hit = F.coalesce(*[F.col(c) for c in tmp]).isNotNull()
    return df.withColumn(name, F.when(hit, 1).otherwise(0)).drop(*tmp)


def allow_list_flag(df: DataFrame, entries: DataFrame, entry_on: Sequence[tuple], entry_marker: str,
                    scope_on: Sequence[tuple], name: str) -> DataFrame:
    """Allow list that is open by default.

    A row is excluded (flag 1) only when its scope (e.g. client + source)
    has at least one entry and none of the entries matches the row.  The
    scope list is the distinct scope keys of ``entries``.
    """
    scope_cols = [rc for _, rc in scope_on]
    scopes = entries.select(*scope_cols).distinct().withColumn("_scope_hit", F.lit(1))
    df = left_lookup(df, entries, entry_on, {"_entry_hit": entry_marker})
    df = left_lookup(df, scopes, scope_on, {"_scope_hit": "_scope_hit"})
    excluded = F.col("_entry_hit").isNull() & F.col("_scope_hit").isNotNull()
    return df.withColumn(name, F.when(excluded, 1).otherwise(0)).drop("_entry_hit", "_scope_hit")


def semi_by_keys(df: DataFrame, keys: DataFrame, on: Sequence[tuple]) -> DataFrame:
    """Rows of ``df`` whose key appears in ``keys`` (SQL ``IN``; NULL keys never match)."""
    tag = f"_s{next(_uid)}"
    k = keys.select(*[F.col(rc).alias(f"{tag}{i}") for i, (_, rc) in enumerate(on)])
    cond = None
    for i, (lc, _) in enumerate(on):
        c = as_col(lc) == F.col(f"{tag}{i}")
        cond = c if cond is None else cond & c
    return df.join(k, cond, "left_semi")


def require_unique(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """``df`` again; the job fails if ``keys`` (NULL counts as a value) repeat.

    One row per repeated key is all that is looked at (partial counts); the
    check runs with the job that uses the result.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    found = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    worst = counts.agg(F.max(F.when(F.col("_n") > 1, found)).alias("_repeated"))
    message = F.concat(F.lit(f"{what}: repeated key "), F.col("_repeated"))
    checked = worst.select(F.when(F.col("_repeated").isNotNull(), F.raise_error(message)).otherwise(F.lit(1))
                           .cast("int").alias("_unique"))
    tag = f"_u{next(_uid)}"
    one = checked.withColumnRenamed("_unique", tag)      # one row by construction
    return (df.withColumn(f"{tag}_one", F.lit(1))
            .join(F.broadcast(one), F.col(f"{tag}_one") == F.col(tag)).drop(tag, f"{tag}_one"))
