import json

import pytest
from pyspark.sql import functions as F

from martkit.operators import (
    as_view, clean_column_names, flatten_structs, strict_select, unpivot_columns, with_literals,
)

MONTHS = [f"m{i:02d}" for i in range(1, 13)]


def test_unpivot_keeps_null_months(spark):
    # One row, month 2 NULL -> 12 rows, month 2 amount NULL; month is text.
    vals = [100 * i for i in range(1, 13)]
    vals[1] = None
    df = spark.createDataFrame([tuple(["a"] + vals)], "k string, " + ", ".join(f"{m} bigint" for m in MONTHS))
    out = unpivot_columns(df, MONTHS, ["k"], "fiscal_month", "amount", divisor=100)
    got = {r.fiscal_month: r.amount for r in out.collect()}
    assert len(got) == 12 and got["2"] is None and got["1"] == 1.0 and got["12"] == 12.0
    assert out.schema["fiscal_month"].dataType.simpleString() == "string"


def test_unpivot_invariants(spark):
    # 12 x input rows; sum of long amounts = sum of wide amounts.
    df = spark.range(50).select(F.col("id").cast("string").alias("k"),
                                *[(F.col("id") * (i + 1)).alias(m) for i, m in enumerate(MONTHS)])
    out = unpivot_columns(df, MONTHS, ["k"], divisor=None)
    assert out.count() == 12 * 50
    wide = df.select(sum(F.col(m) for m in MONTHS).alias("s")).agg(F.sum("s")).first()[0]
    assert out.agg(F.sum("amount")).first()[0] == wide


def test_unpivot_is_a_generate(spark):
    df = spark.createDataFrame([("a", *range(12))], "k string, " + ", ".join(f"{m} int" for m in MONTHS))
    plan = unpivot_columns(df, MONTHS, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Exchange" not in plan


def test_flatten_and_clean(spark):
    # P8 + P10: {a:{b:1,c:{d:"x"}},"x y":2} -> a_b, a_c_d, x_y; lists stay lists.
    doc = {"a": {"b": 1, "c": {"d": "x"}}, "x y": 2, "l": [1, 2]}
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps(doc)]))
    out = clean_column_names(flatten_structs(df))
    assert sorted(out.columns) == ["a_b", "a_c_d", "l", "x_y"]
    r = out.first()
    assert (r.a_b, r.a_c_d, r.x_y, list(r.l)) == (1, "x", 2, [1, 2])


def test_clean_names_keeps_letters_and_detects_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "`é.b` int, `c-d` int")
    assert clean_column_names(df).columns == ["é_b", "c_d"]
    with pytest.raises(ValueError, match="collide"):
        clean_column_names(spark.createDataFrame([(1, 2)], "`a.b` int, a_b int"))


def test_strict_select(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert strict_select(df, ["b", "a"]).columns == ["b", "a"]
    with pytest.raises(ValueError, match="missing columns: \\['c', 'd'\\]"):
        strict_select(df, ["a", "c", "d"])


def test_literals_and_view(spark):
    df = with_literals(spark.createDataFrame([(1,)], "a int"), SequenceNumber=100, DeltaValue=None)
    r = df.first()
    assert (r.SequenceNumber, r.DeltaValue) == (100, None)
    v = as_view(df, ["x", "y", "z"], "positional_view")
    assert v.columns == ["x", "y", "z"]
    assert spark.sql("select x from positional_view").first()[0] == 1
    with pytest.raises(ValueError):
        as_view(df, ["x"])
