from pyspark.sql import functions as F

from martkit.functions import (
    bracket, concat_blank, concat_strict, div0, julian_key, left_of_number, lpad_number, period_id,
    to_cents, ts_text, underscore_spaces, yyyymmdd,
)


def one(spark, expr, schema="a string, b string"):
    return spark.createDataFrame([("x", None)], schema).select(expr.alias("r")).first()["r"]


def test_concat_null_rules(spark):
    # NULL in, NULL out; C2: NULL counts as empty.
    assert one(spark, concat_strict(F.col("a"), F.col("b"))) is None
    assert one(spark, concat_blank(F.col("b"), "_", F.lit("t"), ".parquet")) == "_t.parquet"
    assert one(spark, concat_blank(F.col("a"), "-")) == "x-"


def test_bracket_and_underscores(spark):
    df = spark.createDataFrame([("Order Date",), (None,)], "n string")
    got = [r[0] for r in df.select(underscore_spaces(bracket("n"))).collect()]
    assert got == ["[Order_Date]", None]


def test_lpad_and_left(spark):
    df = spark.createDataFrame([(1, 202301.0), (12, 199912.0)], "p int, ym double")
    got = df.select(lpad_number("p", 2).alias("a"), left_of_number("ym", 4).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [("01", "2023"), ("12", "1999")]


def test_div0(spark):
    # x/0 -> 0, x/NULL -> NULL.
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(div0("a", "b")).collect()] == [0.0, None, 1.5]


def test_period_and_cents(spark):
    df = spark.createDataFrame([("2023", "7", 12.345)], "y string, m string, v double")
    r = df.select(period_id("y", "m").alias("p"), to_cents("v").alias("c")).first()
    assert (r.p, r.c) == (202307, 1235)


def test_dates(spark):
    df = spark.sql("select date'2024-02-01' d, timestamp_ntz'2024-01-30 23:59:59' t")
    r = df.select(julian_key("d").alias("j"), yyyymmdd("d").alias("y"), ts_text("t").alias("a"),
                  ts_text("t", quoted=True).alias("q")).first()
    assert (r.j, r.y, r.a, r.q) == (2024032, "20240201", "2024-01-30T23:59:59Z", "'2024-01-30T23:59:59Z'")
