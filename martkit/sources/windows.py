"""Day windows for pulling (or slicing) the N full days before a run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.functions.dates import ts_text, yyyymmdd


def day_windows(spark: SparkSession, run_ts: dt.datetime, n_days: int,
                closed_second: bool = False) -> DataFrame:
    """One row per full day before ``run_ts``: ``window_day`` (date),
    ``window_start`` and ``window_end`` (timestamp_ntz), ``load_date``
    (``YYYYMMDD``).  Every day is emitted (batches of any size).

    Default windows are half-open ``[d, d+1)``.  ``closed_second=True``
    gives the original ``[d 00:00:00, d 23:59:59]`` bounds, which lose
    fractions of the last second.  Size is ``n_days`` rows, fixed by the
    parameter, so joining it by broadcast is safe.
    """
    run_day = run_ts.date()
    days = spark.range(1, n_days + 1).select(
        F.date_sub(F.lit(run_day), F.col("id").cast("int")).alias("window_day"))
    start = F.to_timestamp_ntz(F.col("window_day").cast("string"))
    if closed_second:
        end = start + F.expr("interval 23 hours 59 minutes 59 seconds")
    else:
        end = start + F.expr("interval 1 day")
    return days.select("window_day", start.alias("window_start"), end.alias("window_end"),
                       yyyymmdd("window_day").alias("load_date"))


def assign_day_window(df: DataFrame, ts_col: str, windows: DataFrame,
                      closed_second: bool = False) -> DataFrame:
    """Attach each row to its day window (rows outside every window drop).

    Equi-join on the day of ``ts_col`` (a hash join key) plus a residual
    range check, instead of a range-only theta join.
    """
    w = F.broadcast(windows)
    in_range = (F.col(ts_col) >= F.col("window_start")) & (
        (F.col(ts_col) <= F.col("window_end")) if closed_second else (F.col(ts_col) < F.col("window_end")))
    return df.join(w, (F.to_date(F.col(ts_col)) == F.col("window_day")) & in_range, "inner")


def window_texts(df: DataFrame, quoted: bool = False) -> DataFrame:
    """Replace window bounds with the endpoint's text form."""
    return (df.withColumn("start_datetime", ts_text("window_start", quoted))
              .withColumn("end_datetime", ts_text("window_end", quoted)))
