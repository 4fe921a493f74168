"""Parquet sinks and staging file names."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martkit.functions.text import as_col, concat_blank


def write_parquet(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with ``df``."""
    df.write.mode("overwrite").parquet(path)


def write_by_load_date(df: DataFrame, base: str, load_date: str | dt.date,
                       col: str = "load_date") -> None:
    """Write into the dated folder ``base/load_date=YYYYMMDD`` and replace only
    that folder (dynamic partition overwrite), so re-running a day is
    idempotent and other days stay."""
    if isinstance(load_date, dt.date):
        load_date = load_date.strftime("%Y%m%d")
    (df.withColumn(col, F.lit(load_date)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy(col).parquet(base))


def _folder(spark: SparkSession, path: str):
    """Spark's file system and path object for a folder in any store that Spark reaches."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Put the finished folder ``staged`` in the place of ``path``."""
    fs, new = _folder(spark, staged)
    _, old = _folder(spark, path)
    fs.delete(old, True)
    fs.mkdirs(old.getParent())
    if not fs.rename(new, old):
        raise OSError(f"cannot move {staged} to {path}")


def discard(spark: SparkSession, path: str) -> None:
    fs, where = _folder(spark, path)
    fs.delete(where, True)


def write_counted(df: DataFrame, path: str, observation: Observation | None = None, *metrics: Column) -> dict:
    """Write ``df`` once, next to ``path``, and put it there only if it has a row.

    The rows are counted while they are written (``rows`` of the result, with the
    caller's ``metrics``): nothing is computed twice and nothing is kept on executors. A
    failed or empty write leaves what was at ``path`` before.
    """
    spark = df.sparkSession
    seen = observation or Observation()
    staged = f"{path}_staged-{uuid.uuid4().hex}"
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics).write.parquet(staged)
    counts = seen.get
    if counts["rows"]:
        publish(spark, staged, path)
    else:
        discard(spark, staged)
    return counts


def write_if_any(df: DataFrame, path: str, writer: Callable[[DataFrame, str], None] | None = None) -> bool:
    """Write only when ``df`` has a row; returns whether it wrote.

    ``writer`` must leave ``path`` as it is when there is no row (dynamic partition
    overwrite does); without one the rows are written by :func:`write_counted`.
    """
    if writer is None:
        return write_counted(df, path)["rows"] > 0
    seen = Observation()
    writer(df.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    return seen.get["rows"] > 0


def staging_name(schema, table, primary_key: bool = False) -> Column:
    """``schema_table.parquet`` / ``schema_table_PK.parquet``; a NULL part
    counts as empty text."""
    return concat_blank(as_col(schema), "_", as_col(table), "_PK.parquet" if primary_key else ".parquet")
