"""Hot keys: one key holding most rows must give the same answer as the
plain definition, without window functions over that key."""
import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from martkit.operators import best_row_per_key, count_per_key, upsert
from martkit.plans import ledger
from martkit.sources import pages_until_error

HOT = 20000


def hot_frame(spark):
    # Key 0 holds 20000 rows, keys 1..99 one row each.
    return spark.range(HOT + 99).select(
        F.when(F.col("id") < HOT, F.lit(0)).otherwise(F.col("id") - HOT + 1).alias("k"),
        F.col("id"), (F.col("id") * 7919 % 1000).alias("v"))


def test_best_row_hot_key_equals_window(spark):
    df = hot_frame(spark)
    # Descending order: negate the value (struct fields sort ascending).
    got = best_row_per_key(df, ["k"], [-F.col("v"), F.col("id")], ["id", "v"])
    w = Window.partitionBy("k").orderBy(F.col("v").desc(), "id")
    want = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("k", "id", "v")
    assert rows(got) == rows(want)
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def test_count_per_key_hot_key(spark):
    df = hot_frame(spark)
    got = count_per_key(df, ["k"], F.when(F.col("v") > 500, F.col("v")), "n")
    w = Window.partitionBy("k")
    want = df.withColumn("n", F.count(F.when(F.col("v") > 500, F.col("v"))).over(w))
    assert rows(got, "k", "id", "n") == rows(want, "k", "id", "n")


def test_page_chain_hot_chain(spark):
    df = spark.range(1, 20_001).select(F.lit(0).alias("k"), "id").union(
        spark.range(1, 100).select(F.lit(1).alias("k"), "id"))
    ok = (F.col("k") != 0) | (F.col("id") != 12_345)
    out = pages_until_error(df, ["k"], "id", ok, F.col("id") != 99)
    assert out.filter("k = 0").count() == 99                       # page 99 has no next link
    out = pages_until_error(df, ["k"], "id", ok, F.lit(True))
    assert out.filter("k = 0").count() == 12_344 and out.filter("k = 1 and not complete").count() == 99
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_upsert_null_keys_are_spread(spark):
    tgt = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(1.0).alias("v"))
    src = spark.range(5000).select(F.when(F.col("id") < 4900, F.lit(None)).otherwise(F.col("id").cast("string"))
                                   .alias("k"), F.lit(2.0).alias("v"))
    out = upsert(tgt, src, ["k"])
    assert out.count() == 100 + 5000
    assert out.filter("k is null").count() == 4900
    # The salt takes part in the hash, so the NULL-key rows of one table land in many partitions.
    from martkit.operators.upsert import _salt
    salted = src.withColumn("salt", _salt(["k"], ["v"])).filter("k is null")
    src2 = src.withColumn("v", F.col("v") + F.monotonically_increasing_id())
    spread = src2.withColumn("salt", _salt(["k"], ["v"])).filter("k is null").repartition(8, "k", "salt")
    assert salted.filter("salt = 0").count() == 0
    assert max(spread.groupBy(F.spark_partition_id()).count().toPandas()["count"]) < 1000


def test_ledger_hot_business_unit(spark):
    from test_ledger import _inputs
    amounts = [-10000, 5000, -20000, 8000, -30000, 9000, -15000, 4000]
    pr_rows = [(2023032, "1", "BU1", *amounts, 0, 0), (2023032, "2", "BU1", *amounts, 0, 0)]
    ab, am, bum, cc, dd, codes, pr = _inputs(spark, pr_rows)
    # Many accounts in one business unit.
    ab = ab.crossJoin(spark.range(200).withColumnRenamed("id", "n")).withColumn(
        "account_id", F.concat(F.col("account_id"), F.col("n").cast("string"))).drop("n")
    out = ledger.ledger_fact(ab, am, bum, cc, dd, codes, pr, dt.datetime(2024, 6, 1))
    assert out.count() == 200 * 13


def test_upsert_hot_duplicate_new_key(spark):
    # 3000 source rows share one new key: all inserted.
    tgt = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(1.0).alias("v"))
    src = spark.range(3000).select(F.lit("new").alias("k"), F.col("id").cast("double").alias("v")).unionByName(
        spark.createDataFrame([("5", 9.0)], "k string, v double"))
    out = upsert(tgt, src, ["k"])
    assert out.count() == 3100 and out.filter("k = 'new'").count() == 3000
    assert out.filter("k = '5'").first().v == 9.0
