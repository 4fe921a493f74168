"""Keyed upsert (MERGE) as two joins that Spark can split where a key is hot.

Parquet tables cannot be merged in place, and overwriting a path while it is
being read destroys it: :func:`upsert` computes the merged table, and
:func:`write_merged` writes it to a new path that the caller names.
:func:`merge_partitions` does the same for a partitioned target, for the partitions
that the source touches and no others.

Plan: updated rows are the target LEFT JOIN one row per source key (counted and
combined map-side, so a key with many source rows arrives as one row); inserted
rows are the source LEFT ANTI JOIN the target's keys. Adaptive execution splits the
left side of either at a hot key, which it cannot do in a full outer join. Rows with a
NULL key part can never match; a salt that is constant for all other rows spreads
them over all tasks. The target's values are read once, its keys twice.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _salt(keys: list[str], values: list[str]) -> Column:
    """0 for rows whose keys can match; a spread-out number for rows with a NULL key part."""
    any_null = reduce(or_, [F.col(k).isNull() for k in keys])
    return F.when(any_null, F.xxhash64(*keys, *values)).otherwise(F.lit(0).cast("bigint"))


def _no_salt(keys: list[str]) -> Column:
    """0, but not a constant to the optimizer: it stays a part of the join's partitioning."""
    return F.xxhash64(*keys) % 1


def upsert(target: DataFrame, source: DataFrame, keys: list[str], run_ts: dt.datetime | None = None,
           stamp_col: str | None = None, only_changed: bool = False,
           check_duplicates: bool = True) -> DataFrame:
    """Merged table: matched keys take the source values, source-only keys
    are inserted, target-only rows stay.

    * Keys compare with ``=``: a NULL key never matches, so such source rows
      are inserted (again on every run).
    * ``stamp_col`` (in the target only) is set to ``run_ts`` on updated
      rows, kept on untouched rows and NULL on inserted rows.
    * ``only_changed``: a matched row counts as updated only when some
      value differs (NULL-safe); otherwise it is left as it was.
    * ``check_duplicates``: several source rows for one existing target row
      fail the job (``raise_error``, evaluated on the executors).  Several
      source rows of a new key are all inserted.
    """
    values = [c for c in target.columns if c not in keys and c != stamp_col]
    missing = [c for c in keys + values if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks columns {missing}")
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in keys + values], _salt(keys, values).alias("s__salt"))
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns], _salt(keys, values).alias("t__salt"))
    s_keys, t_keys = [[f"{side}_{k}" for k in keys] + [f"{side}__salt"] for side in "st"]
    same = reduce(and_, [F.col(a) == F.col(b) for a, b in zip(t_keys, s_keys)])
    known = reduce(and_, [F.col(f"s_{k}").isNotNull() for k in keys])

    by_key = s.filter(known).withColumn("s__salt", _no_salt([f"s_{k}" for k in keys]))
    if check_duplicates:
        by_key = by_key.groupBy(*s_keys).agg(
            F.count(F.lit(1)).alias("_n"), *[F.first(f"s_{c}").alias(f"s_{c}") for c in values])
    joined = t.join(by_key, same, "left")
    updated = F.col("s__salt").isNotNull()
    if only_changed:
        differs = [~F.col(f"t_{c}").eqNullSafe(F.col(f"s_{c}")) for c in values]
        updated = updated & reduce(or_, differs, F.lit(False))
    merged = {c: F.when(updated, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")) for c in values}
    merged |= {k: F.col(f"t_{k}") for k in keys}
    if check_duplicates:
        first = keys[0]
        message = F.concat(F.lit("upsert: several source rows for one target key "), F.col(f"s_{first}").cast("string"))
        merged[first] = F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(merged[first])
    new = {c: F.col(f"s_{c}") for c in keys + values}
    if stamp_col:
        kind = target.schema[stamp_col].dataType
        stamp = F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(kind)   # no local-zone shift
        merged[stamp_col] = F.when(updated, stamp).otherwise(F.col(f"t_{stamp_col}"))
        new[stamp_col] = F.lit(None).cast(kind)
    there = target.select(*[F.col(k).alias(f"t_{k}") for k in keys], _no_salt(keys).alias("t__salt"))
    there = there.filter(reduce(and_, [F.col(f"t_{k}").isNotNull() for k in keys]))
    inserted = s.join(there, same, "left_anti")
    return (joined.select(*[merged[c].alias(c) for c in target.columns])
            .union(inserted.select(*[new[c].alias(c) for c in target.columns])))


def write_merged(target: DataFrame, source: DataFrame, keys: list[str], path: str, **options) -> None:
    """Write :func:`upsert` of the two to ``path``, which must not exist yet.

    The target's files stay as they are, so a failed run changes nothing and a
    rerun starts from the same tables; the caller decides which path is current.
    """
    upsert(target, source, keys, **options).write.mode("errorifexists").parquet(path)


def touched_partitions(source: DataFrame, partition: str) -> list:
    """The partition values of ``source``; as many as the target has folders, which Spark lists on the driver anyway."""
    return [r[0] for r in source.select(partition).distinct().collect()]


def merge_partitions(spark: SparkSession, path: str, source: DataFrame, keys: list[str], partition: str, staged: str,
                     **options) -> list:
    """Merge ``source`` into the table at ``path``, partitioned by ``partition`` (one of ``keys``); returns the
    partition values that were rewritten.

    Only the partitions that ``source`` touches are read (a partition filter on the scan) and written. Their
    merged rows go to the new folder ``staged`` first, and from there take their partitions' place by dynamic
    partition overwrite: a run that fails before that has changed nothing, one that fails later is finished by
    :func:`publish_partitions`. Source rows without a partition value go to Spark's default partition.
    """
    if partition not in keys:
        raise ValueError("rows can move between partitions: the partition column must be one of the keys")
    values = touched_partitions(source, partition)
    stored = spark.read.parquet(path)
    named, empty = [v for v in values if v is not None], F.lit(False)
    touched = F.col(partition).isin(named) if named else empty
    if None in values:
        touched = touched | F.col(partition).isNull()
    columns = [*[c for c in stored.columns if c != partition], partition]
    target = stored.filter(touched).select(*columns)
    incoming = source.withColumn(partition, F.col(partition).cast(stored.schema[partition].dataType))
    merged = upsert(target, incoming, keys, **options)
    merged.write.mode("errorifexists").partitionBy(partition).parquet(staged)
    publish_partitions(spark, staged, path, partition)
    return sorted(values, key=lambda v: (v is None, v))


def publish_partitions(spark: SparkSession, staged: str, path: str, partition: str) -> None:
    """Let the partitions at ``staged`` take the place of those at ``path``; others stay."""
    kept = spark.read.parquet(path).schema
    (spark.read.schema(kept).parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))
