import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from conftest import rows
from martkit.operators.upsert import merge_partitions, publish_partitions, upsert, write_merged

TS = dt.datetime(2024, 2, 1, 12, 0, 0)
SCHEMA = "id string, line string, amount double, note string"
TSCHEMA = SCHEMA + ", modified timestamp_ntz"


def target(spark):
    old = dt.datetime(2020, 1, 1)
    return spark.createDataFrame([("1", "a", 1.0, "t1", old), ("2", "a", 2.0, "t2", old)], TSCHEMA)


def source(spark, extra=()):
    return spark.createDataFrame([("2", "a", 20.0, "s2"), ("3", "a", 3.0, "s3"), (None, "a", 9.0, "sn"), *extra],
                                 SCHEMA)


def test_upsert_match_insert_keep(spark):
    # M1/M3: target {1,2}, source {2,3,null} -> 1, 2 (updated), 3, null.
    out = upsert(target(spark).drop("modified"), source(spark), ["id", "line"])
    assert rows(out) == [(None, "a", 9.0, "sn"), ("1", "a", 1.0, "t1"), ("2", "a", 20.0, "s2"), ("3", "a", 3.0, "s3")]


def test_upsert_stamp_on_update_only(spark):
    # M2: the stamp is set on updated rows only; inserted rows get NULL.
    out = upsert(target(spark), source(spark), ["id", "line"], run_ts=TS, stamp_col="modified")
    got = {r.id: r.modified for r in out.collect()}
    assert got == {"1": dt.datetime(2020, 1, 1), "2": TS, "3": None, None: None}


def test_upsert_only_changed(spark):
    # M5: an unchanged matched row keeps its old stamp.
    src = spark.createDataFrame([("1", "a", 1.0, "t1"), ("2", "a", 2.5, "t2")], SCHEMA)
    out = upsert(target(spark), src, ["id", "line"], run_ts=TS, stamp_col="modified", only_changed=True)
    got = {r.id: (r.amount, r.modified) for r in out.collect()}
    assert got == {"1": (1.0, dt.datetime(2020, 1, 1)), "2": (2.5, TS)}


def test_upsert_duplicate_source_rows_for_existing_key_fail(spark):
    # M4: two source rows for existing key 2 -> error; two rows of a new key are both inserted.
    bad = upsert(target(spark).drop("modified"), source(spark, [("2", "a", 21.0, "dup")]), ["id", "line"])
    with pytest.raises((PySparkException, Py4JJavaError), match="several source rows"):
        bad.collect()
    ok = upsert(target(spark).drop("modified"), source(spark, [("3", "a", 4.0, "dup")]), ["id", "line"])
    assert len([r for r in ok.collect() if r.id == "3"]) == 2


def test_write_merged_twice(spark, tmp_dir):
    # Row count = |target keys U source keys|; the NULL-key row is inserted again on each run.
    write_merged(target(spark).drop("modified"), source(spark), ["id", "line"], f"{tmp_dir}/v1")
    once = spark.read.parquet(f"{tmp_dir}/v1")
    assert once.count() == 4
    write_merged(once, source(spark), ["id", "line"], f"{tmp_dir}/v2")
    cur = spark.read.parquet(f"{tmp_dir}/v2")
    assert cur.count() == 5 and cur.filter("id is null").count() == 2
    assert {r.id: r.amount for r in cur.filter("id is not null").collect()} == {"1": 1.0, "2": 20.0, "3": 3.0}
    with pytest.raises(PySparkException):                          # an existing path is never replaced
        write_merged(once, source(spark), ["id", "line"], f"{tmp_dir}/v2")


def test_upsert_twice_equals_once_apart_from_stamp(spark):
    # Invariant: with unique non-NULL keys, merging the same source again
    # changes nothing but the modification stamp.
    src = spark.createDataFrame([("2", "a", 20.0, "s2"), ("3", "a", 3.0, "s3")], SCHEMA)
    once = upsert(target(spark), src, ["id", "line"], run_ts=TS, stamp_col="modified")
    twice = upsert(once, src, ["id", "line"], run_ts=dt.datetime(2025, 1, 1), stamp_col="modified")
    assert rows(once.drop("modified")) == rows(twice.drop("modified"))
    assert once.count() == twice.count() == 3


def test_upsert_62_columns(spark):
    # M1 at the width of a real fact table: 2 keys, 60 values of several types, a stamp.
    kinds = ["string", "double", "bigint", "date", "boolean", "decimal(18,2)"]
    values = [F.when(F.col("id") % (i + 2) == 0, None).otherwise((F.col("id") * (i + 1)).cast(
        k if k not in ("date", "boolean") else "bigint")).alias(f"v{i:02d}") if k not in ("date", "boolean")
        else ((F.col("id") % 2 == 0) if k == "boolean" else F.date_add(F.lit("2020-01-01").cast("date"),
                                                                      F.col("id").cast("int"))).alias(f"v{i:02d}")
        for i, k in enumerate(kinds * 10)]
    base = spark.range(200).select(F.col("id").cast("string").alias("k1"), (F.col("id") % 7).alias("k2"), *values)
    old = base.filter("v02 < 300").withColumn("stamp", F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"))
    new = base.filter("v02 >= 150").withColumn("v01", F.lit(-1.0))
    assert len(old.columns) == 63
    out = upsert(old, new, ["k1", "k2"], run_ts=TS, stamp_col="stamp")
    assert out.columns == old.columns and [f.dataType for f in out.schema] == [f.dataType for f in old.schema]
    by_key = {r.k1: r for r in out.collect()}
    old_keys, new_keys = ({r.k1 for r in df.select("k1").collect()} for df in (old, new))
    assert set(by_key) == old_keys | new_keys and old_keys & new_keys and old_keys ^ new_keys
    for k, r in by_key.items():
        assert (r.v01 == -1.0) == (k in new_keys)
        assert (r.stamp == TS) == (k in old_keys & new_keys) and (r.stamp is None) == (k not in old_keys)


def test_upsert_plan_reads_the_target_values_once(spark):
    old = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    new = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    keys = ["o_orderkey", "o_custkey"]
    plan = upsert(old, new, keys)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 4                      # either side for updates, and again for inserts
    assert plan.count("ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>") == 1   # of the target only its keys
    assert "LeftOuter" in plan and "LeftAnti" in plan and "FullOuter" not in plan


def test_upsert_hot_new_key_is_split(spark):
    """One new key in a third of the source: its rows are inserted by many tasks."""
    options = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
               "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
               "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in options}
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        old = spark.range(0, 60_000, numPartitions=8).select(F.col("id").alias("k"), F.lit("old").alias("v"))
        new = spark.range(0, 90_000, numPartitions=16).select(
            F.when(F.col("id") < 30_000, -1).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        out = upsert(old, new, ["k"]).withColumn("task", F.spark_partition_id())
        got = out.groupBy("task").agg(F.count("v").alias("n"), F.sum((F.col("k") == -1).cast("int")).alias("hot"), F.max("v")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(r.n for r in got) == 30_000 + 90_000 and sum(r.hot for r in got) == 30_000
    assert sum(r.hot > 0 for r in got) >= 4 and max(r.hot for r in got) <= 15_000


def test_merge_partitions_rewrites_only_what_the_source_touches(spark, tmp_dir):
    path, staged = f"{tmp_dir}/fact", f"{tmp_dir}/staged"
    spark.range(500).select(F.col("id").alias("k"), F.lit("old").alias("v"), (F.col("id") % 50).cast("int").alias("day")
                            ).write.partitionBy("day").parquet(path)
    files = {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("day=")}
    src = spark.createDataFrame([(7, "new", 7), (57, "new", 7), (1007, "add", 7)], "k long, v string, day int")
    assert merge_partitions(spark, path, src, ["k", "day"], "day", staged) == [7]
    again = {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("day=")}
    assert [d for d in files if files[d] != again[d]] == ["day=7"] and len(files) == 50
    assert sorted(os.listdir(staged))[-1] == "day=7"
    out = spark.read.parquet(path)
    assert out.count() == 501 and rows(out.filter("day = 7 and v <> 'old'"), "k", "v") == [(7, "new"), (57, "new"), (1007, "add")]
    # a new partition, and rows without one
    src = spark.createDataFrame([(1, "x", 99), (2, "y", None)], "k long, v string, day int")
    assert merge_partitions(spark, path, src, ["k", "day"], "day", f"{tmp_dir}/staged2") == [99, None]
    assert spark.read.parquet(path).count() == 503
    target = spark.read.parquet(path).filter(F.col("day").isin([7]))
    assert re.search(r"PartitionFilters: \[.*day.*7", target._jdf.queryExecution().executedPlan().toString())
    with pytest.raises(ValueError, match="one of the keys"):
        merge_partitions(spark, path, src, ["k"], "day", f"{tmp_dir}/staged3")
    with pytest.raises(PySparkException):                          # a staged folder is never reused
        merge_partitions(spark, path, src, ["k", "day"], "day", staged)
    publish_partitions(spark, staged, path, "day")                 # finishing a run again changes nothing
    assert spark.read.parquet(path).count() == 503
