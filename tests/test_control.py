from pyspark.sql import functions as F

from martkit.plans.control import OUTPUT_COLUMNS, control_statements

K = "database_id int, ServerName string, ClientName string"
DBK = (5, "srv", "cl")


def catalog(spark, exclusions=()):
    c = spark.createDataFrame
    return dict(
        objects=c([(1, 1, "db", "USER_TABLE", *DBK), (2, 1, "db", "USER_TABLE", *DBK), (3, 1, "db", "VIEW", *DBK)],
                  f"object_id int, schema_id int, DatabaseName string, type_desc string, {K}"),
        schemas=c([(1, "dbo", *DBK)], f"schema_id int, name string, {K}"),
        tables=c([(1, "Orders", "db", *DBK), (2, "Empty", "db", *DBK)],
                 f"object_id int, name string, DatabaseName string, {K}"),
        columns=c([(1, 1, "Order Id", *DBK), (1, 2, "Amount", *DBK), (2, 1, "x", *DBK)],
                  f"object_id int, column_id int, name string, {K}"),
        info_columns=c([("dbo", "Orders", "Order Id", 1, *DBK), ("dbo", "Orders", "Amount", 2, *DBK),
                        ("dbo", "Empty", "x", 1, *DBK)],
                       f"TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, ORDINAL_POSITION int, {K}"),
        partitions=c([(1, 1, 10, *DBK), (1, 2, 99, *DBK), (2, 0, 0, *DBK)], f"object_id int, index_id int, rows bigint, {K}"),
        indexes=c([(1, 1, "pk", 1, 1, 0, 1, "db", *DBK), (1, 3, "ux", 2, 0, 0, 1, "db", *DBK)],
                  "object_id int, index_id int, name string, type int, is_primary_key int, is_unique_constraint int, "
                  f"is_unique int, DatabaseName string, {K}"),
        index_columns=c([(1, 1, 1, *DBK)], f"object_id int, index_id int, column_id int, {K}"),
        source_db=c([("cl", "srv", "db", "SA", "ERP", "lake", "sql")],
                    "ClientName string, ServerName string, DatabaseName string, SourceAbbreviation string, "
                    "SourceSystemName string, DataLakeName string, SourceDataStructure string"),
        delta_columns=c([("ERP", None, "Amount", None, None, None)],
                        "SourceName string, TableName string, DeltaColumn string, ClientName string, "
                        "DatabaseName string, ServerName string"),
        exclusions=c(list(exclusions), "SourceName string, TableNameForExclusion string, "
                     "ColumnNameForExclusion string, ClientName string"),
        inclusions=c([], "SourceName string, ClientName string, TableNameForInclusion string, SchemaId int"),
    )


def tail(server="srv", db="db", table="[dbo].[Orders]"):
    return (f" \n\t\t, '{server}' AS [SourceServerName] \n\t\t, '{db}' AS [SourceDatabaseName] "
            f"\n\t FROM [{db}].{table} WITH (NOLOCK)")


def test_control_statements_text(spark):
    out = {r.SourceTableName: r for r in control_statements(**catalog(spark)).collect()}
    assert set(out) == {"Orders", "Empty"}           # views are not sources
    o = out["Orders"]
    assert o.SourceSelectStatement == "SELECT \n\t\t[Order Id] AS [Order_Id]\n\t\t, [Amount] AS [Amount]" + tail()
    assert o.SourceSelectPKStatement == "SELECT \n\t\t[Order Id] AS [Order_Id]" + tail()
    assert o.PrimaryKeyMergeStatement == "\n\t\tt.Order Id = s.Order Id\n\t\t\t"
    assert (o.SourceRowCount, o.StagingDataFileName, o.PrimaryKeyFileName) == (10, "dbo_Orders.parquet",
                                                                               "dbo_Orders_PK.parquet")
    assert (o.IsTableConsideredActive, o.IsDelta, o.DeltaColumn, o.DeltaValue, o.SequenceNumber) == (1, 1, "Amount",
                                                                                                     None, 100)
    e = out["Empty"]
    # No key columns -> key statement NULL; G4: zero rows -> inactive.
    assert (e.SourceSelectPKStatement, e.PrimaryKeyMergeStatement, e.PrimaryKeyFileName) == (None, None, None)
    assert (e.SourceRowCount, e.IsTableConsideredActive, e.IsDelta) == (0, 0, 0)


def test_output_columns(spark):
    assert control_statements(**catalog(spark)).columns == OUTPUT_COLUMNS


def test_excluded_key_column_leaves_blank_merge_text(spark):
    # The key flag is decided before excluded columns are dropped, so the
    # merge text of a table whose only key column is excluded is blank space.
    ex = [("ERP", "Orders", "Order Id", None)]
    o = [r for r in control_statements(**catalog(spark, ex)).collect() if r.SourceTableName == "Orders"][0]
    assert o.PrimaryKeyMergeStatement == "\n\t\t\n\t\t\t"
    assert o.SourceSelectStatement == "SELECT \n\t\t[Amount] AS [Amount]" + tail()


def test_excluded_table_stays_but_inactive(spark):
    ex = [("ERP", "Orders", None, None)]
    o = [r for r in control_statements(**catalog(spark, ex)).collect() if r.SourceTableName == "Orders"][0]
    assert (o.SourceRowCount, o.IsTableConsideredActive) == (10, 0)


def test_missing_database_name_nulls_statement(spark):
    cat = catalog(spark)
    cat["source_db"] = cat["source_db"].withColumn("DatabaseName", F.lit("other"))
    out = control_statements(**cat).collect()
    assert all(r.SourceSelectStatement is None for r in out)


def test_lookup_checks_and_missing_column_names(spark):
    import pytest
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException
    from pyspark.sql import functions as F

    from conftest import SF_SMALL
    from martkit.plans import catalog, control
    from martkit.plans.queries import Tables
    tables = catalog.catalog_tables(Tables(spark, SF_SMALL))
    plain = control.control_statements(**tables)
    checked = control.control_statements(**tables, check_lookups=True)
    assert checked.count() == plain.count()
    for name, what in (("delta_columns", "delta columns"), ("exclusions", "exclusions"), ("inclusions", "inclusions"),
                       ("source_db", "database ids")):
        twice = tables[name].unionByName(tables[name])
        if name == "source_db":
            twice = tables[name].unionByName(tables[name].withColumn("SourceSystemName", F.lit("other")))
        with pytest.raises((PySparkException, Py4JJavaError), match=f"{what}: repeated key"):
            control.control_statements(**(tables | {name: twice}), check_lookups=True).collect()
    # A table without columns keeps its row, with no statement; no text holds an item without a name.
    none = plain.filter("SourceSelectStatement is null")
    assert none.count() > 0 and plain.filter("SourceSelectStatement like '% AS  %'").count() == 0


def test_names_that_differ_in_case_are_equal_on_request(spark):
    # The columns keep their spelling; client, table and exclusion names are spelt differently in each table.
    cat = catalog(spark, [("erp", "ORDERS", "ORDER ID", None)])
    cat["columns"] = cat["columns"].withColumn("ClientName", F.lit("CL"))
    cat["info_columns"] = cat["info_columns"].withColumn("TABLE_NAME", F.upper("TABLE_NAME"))
    cat["delta_columns"] = cat["delta_columns"].withColumn("DeltaColumn", F.lower("DeltaColumn"))
    plain = {r.SourceTableName: r for r in control_statements(**cat).collect()}
    assert plain["Orders"].SourceSelectStatement is None                         # no column of client "cl"
    out = control_statements(**cat, case_insensitive=True)
    assert all("COLLATE" not in f.dataType.simpleString().upper() for f in out.schema)
    o = {r.SourceTableName: r for r in out.collect()}["Orders"]
    assert o.SourceSelectStatement == "SELECT \n\t\t[Amount] AS [Amount]" + tail()
    assert o.PrimaryKeyMergeStatement == "\n\t\t\n\t\t\t" and o.DeltaColumn == "amount"


def test_observed_drops_equal_the_counted_ones(spark):
    from pyspark.sql import Observation

    from martkit.plans.control import control_columns, drop_metrics
    cat = catalog(spark, [("ERP", "Orders", "Amount", None)])
    cat["columns"] = cat["columns"].filter("object_id = 1")
    seen = Observation()
    assert control_statements(**cat, observation=seen).count() == 2
    counted = control_columns(**cat).agg(*drop_metrics()).first().asDict()
    assert seen.get == counted
    assert counted == {"column_rows": 3, "tables_without_columns": 1, "excluded_columns": 1, "columns_without_position": 0,
                       "rows_without_table": 0, "rows_without_schema": 0, "rows_without_source": 0, "rows_of_inactive_tables": 0}


def test_hot_names_and_wide_tables(spark):
    """Objects without a catalog row share the NULL name; a wide table's texts are built in chunks, in order."""
    cat, n, wide = catalog(spark), 3000, 1000
    ids = spark.range(100, 100 + n)
    keys = [F.lit(5).alias("database_id"), F.lit("srv").alias("ServerName"), F.lit("cl").alias("ClientName")]
    cat["objects"] = cat["objects"].unionByName(ids.select(
        F.col("id").cast("int").alias("object_id"), F.lit(1).alias("schema_id"), F.lit("db").alias("DatabaseName"),
        F.lit("USER_TABLE").alias("type_desc"), *keys))
    columns = spark.range(wide).select(F.lit(2).alias("object_id"), (F.col("id") + 10).cast("int").alias("column_id"),
                                       F.concat(F.lit("c"), F.col("id")).alias("name"), *keys)
    cat["columns"] = cat["columns"].unionByName(columns)
    cat["info_columns"] = cat["info_columns"].unionByName(columns.filter("column_id % 3 = 0").select(
        F.lit("dbo").alias("TABLE_SCHEMA"), F.lit("Empty").alias("TABLE_NAME"), F.col("name").alias("COLUMN_NAME"),
        (5000 - F.col("column_id")).alias("ORDINAL_POSITION"), *keys))
    out = control_statements(**cat)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "collect_list" not in plan
    got = {r.SourceTableName: r for r in out.collect()}
    assert set(got) == {"Orders", "Empty", None}
    ids = [10 + i for i in range(wide)]
    order = [i for i in ids if i % 3] + sorted((i for i in ids if i % 3 == 0), key=lambda i: 5000 - i)
    names = ["x"] + [f"c{i - 10}" for i in order]                                # x has position 1
    missing = [f"c{i - 10}" for i in order if i % 3]
    names = missing + ["x"] + names[1 + len(missing):]
    listed = "\n\t\t, ".join(f"[{c}] AS [{c}]" for c in names)
    assert got["Empty"].SourceSelectStatement == f"SELECT \n\t\t{listed}" + tail(table="[dbo].[Empty]")


def test_names_without_case_are_plain_keys(spark):
    """Folded names are equal where UTF8_LCASE says so, and no key is collated."""
    from martkit.functions.text import fold_case
    letters = [chr(i) for i in range(1, 0x3000)]
    names = spark.createDataFrame([(n,) for x in letters for n in (f"a{x}b", f"A{x}", f"{x.upper()}\u03a3")], "n string")
    folded = names.select(fold_case("n").alias("f"), F.collate("n", "UTF8_LCASE").alias("n"))
    assert folded.filter(F.collate("f", "UTF8_LCASE") != F.col("n")).count() == 0
    assert folded.select("f").distinct().count() == folded.select("n").distinct().count()
    plan = control_statements(**catalog(spark), case_insensitive=True)._jdf.queryExecution().executedPlan().toString()
    assert "collat" not in plan.lower() and "SortAggregate(key=[g_" not in plan


def test_rows_are_told_apart_by_the_table_name_first(spark):
    plan = control_statements(**catalog(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(g_SourceTableName") == 2


def test_an_object_with_two_database_names_has_a_row_for_each_best_index(spark):
    """Every column has a row per best index of its object, and per entry that it has there."""
    from martkit.plans.control import control_columns
    cat = catalog(spark)
    more = spark.createDataFrame([(1, 7, "pk", 1, 1, 0, 1, "other", *DBK)], cat["indexes"].schema)
    cat["indexes"] = cat["indexes"].unionByName(more)
    entries = spark.createDataFrame([(1, 7, 2, *DBK), (1, 7, 2, *DBK), (1, 3, 2, *DBK)], cat["index_columns"].schema)
    cat["index_columns"] = cat["index_columns"].unionByName(entries)
    got = control_columns(**cat).filter("t_name = 'Orders'").select("c_column_id", "ic_column_id").collect()
    # column 1: an entry in index 1, none in index 7; column 2: none in index 1, two in index 7
    assert sorted(map(str, got)) == sorted(f"Row(c_column_id={c}, ic_column_id={i})" for c, i in
                                           ((1, 1), (1, None), (2, None), (2, 2), (2, 2)))


def shuffled(df):
    """Bytes (not compressed) that the run of ``df`` shuffles."""
    df.collect()

    def walk(node):
        name = node.nodeName()
        if name.startswith("ReusedExchange"):
            return 0
        inner = [node.plan()] if name.endswith("QueryStage") else []
        own = node.metrics().apply("dataSize").value() if name == "Exchange" else 0
        return own + sum(walk(x) for x in inner + [node.children().apply(i) for i in range(node.children().size())])
    return walk(df._jdf.queryExecution().executedPlan().executedPlan())


def test_shuffles_move_names_once_and_columns_few_times(spark):
    """Wide rows per column were shuffled for index entries too, and with every name both as spelt and as compared."""
    cat, tables, wide = catalog(spark), 400, 5
    ids = spark.range(10, 10 + tables).select(F.col("id").cast("int").alias("object_id"))
    keys = [F.lit(5).alias("database_id"), F.lit("srv").alias("ServerName"), F.lit("cl").alias("ClientName")]
    column = F.explode(F.sequence(F.lit(1), F.lit(wide))).alias("column_id")
    name = F.concat(F.lit("Table "), F.col("object_id"))
    cat["objects"] = ids.select("object_id", F.lit(1).alias("schema_id"), F.lit("db").alias("DatabaseName"),
                                F.lit("USER_TABLE").alias("type_desc"), *keys)
    cat["tables"] = ids.select("object_id", name.alias("name"), F.lit("db").alias("DatabaseName"), *keys)
    columns = ids.select("object_id", column, *keys)
    cat["columns"] = columns.withColumn("name", F.concat(F.lit("Column "), F.col("column_id")))
    cat["info_columns"] = columns.select(F.lit("dbo").alias("TABLE_SCHEMA"), name.alias("TABLE_NAME"),
                                         F.concat(F.lit("Column "), F.col("column_id")).alias("COLUMN_NAME"),
                                         F.col("column_id").alias("ORDINAL_POSITION"), *keys)
    cat["index_columns"] = columns.filter("column_id <= 2").withColumn("index_id", F.lit(1))
    cat["indexes"] = cat["indexes"].limit(1).drop("object_id").crossJoin(ids)
    cat["partitions"] = cat["partitions"].limit(1).drop("object_id").crossJoin(ids)
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    try:
        for conf in names:
            spark.conf.set(conf, 1500)           # the lookup lists only
        moved = shuffled(control_statements(**cat, case_insensitive=True))
    finally:
        for conf in names:
            spark.conf.unset(conf)
    assert moved < 1400 * tables * wide          # 1,771 bytes a column before
