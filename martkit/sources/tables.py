"""Table scans and derived dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.functions.dates import julian_key


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Named Parquet table ``<directory>/<name>.parquet`` (column pruning and
    filter pushdown happen at this scan)."""
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def date_dimension(df: DataFrame, date_col: str) -> DataFrame:
    """Calendar table covering every day between the min and max of
    ``date_col``: ``julian_date`` (year*1000 + day of year), ``calendar_date``.

    One global min/max (partial aggregate, one row) and two generators, one
    row per year and then one per day of a year; the size is bounded by the
    date span, not by the row count.
    """
    span = df.agg(F.min(F.to_date(date_col)).alias("lo"), F.max(F.to_date(date_col)).alias("hi"))
    years = span.select("lo", "hi", F.explode(F.sequence(F.year("lo"), F.year("hi"))).alias("y"))
    days = years.select(F.explode(F.sequence(F.greatest("lo", F.make_date("y", F.lit(1), F.lit(1))),
                                             F.least("hi", F.make_date("y", F.lit(12), F.lit(31))),
                                             F.expr("interval 1 day"))).alias("calendar_date"))
    return days.select(julian_key("calendar_date").alias("julian_date"), "calendar_date")
