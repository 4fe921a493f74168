from pyspark.sql import functions as F

from conftest import rows
from martkit.operators import (
    allow_list_flag, best_row_per_key, count_per_key, left_join_distinct, left_lookup, listed_flag,
    group_ordered_text, require_unique, semi_by_keys, sum_nonzero, tiered_lookup,
)


def test_left_lookup_constant_in_on_keeps_misses(spark):
    # Right-only conditions restrict the right side; left rows stay.
    left = spark.createDataFrame([("1",), ("2",), ("3",)], "code string")
    codes = spark.createDataFrame([("H50", "TY", "1", "one"), ("H50", "XX", "2", "decoy"), ("09", "TY", "3", "x")],
                                  "product_code string, user_defined_codes string, user_defined_code string, d string")
    out = left_lookup(left, codes, [("code", "user_defined_code")], {"desc": "d"},
                      right_filter=(F.col("product_code") == "H50") & (F.col("user_defined_codes") == "TY"))
    assert rows(out) == [("1", "one"), ("2", None), ("3", None)]


def test_best_row_prefers_primary_key(spark):
    # Unique index id 1, primary key id 5 -> id 5.
    idx = spark.createDataFrame([(7, 1, 0, 0, 1), (7, 5, 1, 0, 1), (8, 2, 0, 1, 1), (8, 3, 0, 1, 1)],
                                "obj int, index_id int, is_pk int, is_uc int, is_u int")
    rank = F.when(F.col("is_pk") == 1, 1).when(F.col("is_uc") == 1, 2).when(F.col("is_u") == 1, 3).otherwise(4)
    out = best_row_per_key(idx, ["obj"], [rank, F.col("index_id")], ["index_id"])
    assert rows(out) == [(7, 5), (8, 2)]


def test_count_per_key_null_keys_group_together(spark):
    # Same table name in two schemas, key in one -> flag 0 for both.
    df = spark.createDataFrame([("s1", "t", 1), ("s2", "t", None), (None, None, None), (None, None, None)],
                               "schema string, tbl string, key int")
    out = count_per_key(df, ["tbl"], F.col("key"), "n")
    assert rows(out, "schema", "tbl", "n") == [(None, None, 0), (None, None, 0), ("s1", "t", 1), ("s2", "t", 1)]


def test_sum_nonzero(spark):
    df = spark.createDataFrame([(1, 5), (1, -5), (2, 3)], "k int, v int")
    assert rows(sum_nonzero(df, ["k"], "v", "s")) == [(2, 3)]


def test_left_join_distinct(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, x string")
    right = spark.createDataFrame([(1, "p"), (1, "p"), (1, "q")], "k2 int, y string")
    out = left_join_distinct(left, right, [("k", "k2")], {"y": "y"}, ["x", "y"])
    assert rows(out) == [("a", "p"), ("a", "q"), ("b", None)]


def test_tiered_lookup_precedence(spark):
    # client+table, then source+table, then source.
    rows_ = spark.createDataFrame([("S", "T", "C1"), ("S", "T", "C2"), ("S", "U", "C1"), ("R", "T", "C1")],
                                  "src string, tbl string, client string")
    dc = spark.createDataFrame([("S", None, None, "general"), ("S", "T", None, "table"), ("S", "T", "C1", "client")],
                               "SourceName string, TableName string, ClientName string, v string")
    out = tiered_lookup(rows_, [
        (dc, [("src", "SourceName"), ("tbl", "TableName"), ("client", "ClientName")], "v", None),
        (dc, [("src", "SourceName"), ("tbl", "TableName")], "v", F.col("ClientName").isNull()),
        (dc, [("src", "SourceName")], "v", F.col("TableName").isNull() & F.col("ClientName").isNull()),
    ], "delta")
    assert rows(out) == [("R", "T", "C1", None), ("S", "T", "C1", "client"), ("S", "T", "C2", "table"),
                         ("S", "U", "C1", "general")]


def test_block_list_levels_and_empty_list(spark):
    # General or client-specific entry -> 1; an empty list gives 0 everywhere.
    rows_ = spark.createDataFrame([("S", "T", "C1"), ("S", "T", "C2"), ("S", "U", "C2")],
                                  "src string, tbl string, client string")
    ex = spark.createDataFrame([("S", "U", None), ("S", "T", "C1")], "SourceName string, Tbl string, ClientName string")
    levels = [(ex, [("src", "SourceName"), ("tbl", "Tbl")], "Tbl", F.col("ClientName").isNull()),
              (ex, [("src", "SourceName"), ("tbl", "Tbl"), ("client", "ClientName")], "Tbl", None)]
    assert rows(listed_flag(rows_, levels, "f")) == [("S", "T", "C1", 1), ("S", "T", "C2", 0), ("S", "U", "C2", 1)]
    empty = ex.limit(0)
    levels0 = [(empty, l[1], l[2], l[3]) for l in levels]
    assert {r.f for r in listed_flag(rows_, levels0, "f").collect()} == {0}


def test_allow_list_open_by_default(spark):
    # No entry for the pair -> kept; entry for another table -> excluded; entry for this table -> kept.
    rows_ = spark.createDataFrame([("C9", "S", "T"), ("C1", "S", "T"), ("C1", "S", "U")],
                                  "client string, src string, tbl string")
    inc = spark.createDataFrame([("C1", "S", "U")], "ClientName string, SourceName string, Tbl string")
    out = allow_list_flag(rows_, inc, [("client", "ClientName"), ("src", "SourceName"), ("tbl", "Tbl")], "Tbl",
                          [("client", "ClientName"), ("src", "SourceName")], "excluded")
    assert rows(out) == [("C1", "S", "T", 1), ("C1", "S", "U", 0), ("C9", "S", "T", 0)]


def test_semi_join_drops_null_keys(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "k int")
    keys = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(semi_by_keys(df, keys, [("k", "k")])) == [(1,)]


def test_require_unique(spark):
    import pytest
    from pyspark.errors import PySparkException
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a")], "k int, v string")
    assert rows(require_unique(df, ["k", "v"], "pairs")) == rows(df)
    assert require_unique(df.filter("k = 5"), ["k"], "none").count() == 0
    for twice, key in ((df, "1"), (df.unionByName(df).filter("k is null"), "NULL")):
        with pytest.raises(PySparkException, match=f"keys: repeated key {key}"):
            require_unique(twice, ["k"], "keys").collect()


def test_best_row_descending_text_and_dates(spark):
    df = spark.sql("select * from values (1, 'a', date'2020-01-01'), (1, 'b', date'2020-01-01'), (1, 'b', null), "
                   "(2, null, date'2021-01-01') as t(k, s, d)")
    got = best_row_per_key(df, ["k"], [F.col("s").desc(), F.col("d").asc_nulls_last()], ["s", "d"])
    assert [tuple(r)[:2] for r in got.orderBy("k").collect()] == [(1, "b"), (2, None)]
    assert got.filter("k = 1").first().d is not None
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()


def test_ordered_text_hot_group(spark):
    # One key holds most rows; its text is built in chunks. NULLs are skipped, a group of only NULLs gives NULL.
    df = spark.range(3000).select(
        F.when(F.col("id") < 2500, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")).alias("k"),
        F.col("id"), F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("v"))
    df = df.unionByName(spark.createDataFrame([("nulls", 1, None)], "k string, id long, v string"))
    a = group_ordered_text(df, ["k"], F.col("v"), [F.col("id")], ",", "t", F.floor(F.col("id") / 100))
    b = group_ordered_text(df, ["k"], F.col("v"), [F.col("id")], ",", "t", F.lit(0))
    assert rows(a) == rows(b)
    got = dict(rows(a))
    assert got["nulls"] is None
    assert got["hot"] == ",".join(str(i) for i in range(2500) if i % 5)
