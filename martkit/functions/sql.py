"""SQL surface: warehouse functions as Spark SQL functions.

``CREATE TEMPORARY FUNCTION ... RETURN <expression>`` functions are
inlined by the analyzer, so SQL written against them stays inside
whole-stage code generation (no Python in the plan).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession


def register_sql_functions(spark: SparkSession, run_ts: dt.datetime | None = None) -> list[str]:
    """Register ``div0(a, b)`` and, when ``run_ts`` is given, ``run_ts()``
    (the run time used in place of "now", so results repeat)."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION div0(a DOUBLE, b DOUBLE) RETURNS DOUBLE "
              "RETURN CASE WHEN b = 0 THEN 0D ELSE a / b END")
    names = ["div0"]
    if run_ts is not None:
        spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION run_ts() RETURNS TIMESTAMP_NTZ "
                  f"RETURN TIMESTAMP_NTZ '{run_ts.strftime('%Y-%m-%d %H:%M:%S')}'")
        names.append("run_ts")
    return names
