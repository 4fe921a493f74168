"""Catalog extracts for the control-statement plan, derived from the given
tables: every order is a source table, its line numbers are its columns.

Database, server and client follow from the order key, so catalog rows
made from ``lineitem`` and from ``orders`` agree without a join.  The
lookup lists (delta columns, block list, allow list) are derived from
``nation``.  ``martkit.plans.oracle`` holds the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col

# Fixed values of our derivation: schema names by schema id (id 3 has none).
SCHEMA_NAMES = ["dbo", "sales", "hr"]


def _db_keys(k: Column) -> list[Column]:
    return [(k % 2 + 1).cast("int").alias("database_id"),
            F.concat(F.lit("srv"), (k % 2).cast("string")).alias("ServerName"),
            F.concat(F.lit("client"), (k % 3).cast("string")).alias("ClientName")]


def _db_name(k: Column) -> Column:
    return F.concat(F.lit("db"), (k % 2 + 1).cast("string"))


def _schema_name(k: Column) -> Column:
    s = k % 4
    return F.when(s == 0, SCHEMA_NAMES[0]).when(s == 1, SCHEMA_NAMES[1]).when(s == 2, SCHEMA_NAMES[2])


def catalog_tables(t) -> dict[str, DataFrame]:
    o, li, n_ = t.orders, t.lineitem, t.nation
    k = c("o_orderkey")
    objects = o.select(k.alias("object_id"), (k % 4).cast("int").alias("schema_id"),
                       _db_name(k).alias("DatabaseName"),
                       F.when(c("o_orderstatus") == "P", "VIEW").otherwise("USER_TABLE").alias("type_desc"),
                       *_db_keys(k))
    schema_list = F.array(*[F.struct(F.lit(i).alias("schema_id"), F.lit(s).alias("name"))
                            for i, s in enumerate(SCHEMA_NAMES)])
    schemas = (objects.select("database_id", "ServerName", "ClientName").distinct()
               .select("*", F.explode(schema_list).alias("_s")).select("_s.schema_id", "_s.name",
                                                                       "database_id", "ServerName", "ClientName"))
    tables = o.select(k.alias("object_id"), F.concat(F.lit("T"), k.cast("string")).alias("name"),
                      _db_name(k).alias("DatabaseName"), *_db_keys(k))

    lk = c("l_orderkey")
    cols = li.select("l_orderkey", "l_linenumber").distinct()
    columns = cols.select(lk.alias("object_id"), c("l_linenumber").alias("column_id"),
                          F.concat(F.lit("col "), c("l_linenumber").cast("string")).alias("name"), *_db_keys(lk))
    # The last line's column is listed under another name, so it has no position.
    info_name = F.when(c("l_linenumber") <= 6, "col ").otherwise("column ")
    info_columns = cols.select(
        _schema_name(lk).alias("TABLE_SCHEMA"), F.concat(F.lit("T"), lk.cast("string")).alias("TABLE_NAME"),
        F.concat(info_name, c("l_linenumber").cast("string")).alias("COLUMN_NAME"),
        (F.lit(100) - c("l_linenumber")).alias("ORDINAL_POSITION"), *_db_keys(lk))
    partitions = li.select(lk.alias("object_id"), (c("l_linenumber") % 3).alias("index_id"),
                           F.when(c("l_returnflag") == "N", F.lit(0).cast("bigint"))
                           .otherwise(c("l_quantity").cast("bigint")).alias("rows"), *_db_keys(lk))
    index_columns = cols.select(lk.alias("object_id"),
                                F.when(c("l_linenumber") <= 2, 1).otherwise(2).alias("index_id"),
                                c("l_linenumber").alias("column_id"), *_db_keys(lk))

    pk = F.when(c("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1).otherwise(0)
    uq = F.when(c("o_orderstatus") == "F", 1).otherwise(0)

    def idx(i, prefix, typ, is_pk, is_uc, is_u):
        return F.struct(F.lit(i).alias("index_id"), F.concat(F.lit(prefix), k.cast("string")).alias("name"),
                        F.lit(typ).alias("type"), is_pk.alias("is_primary_key"),
                        is_uc.alias("is_unique_constraint"), is_u.alias("is_unique"))

    indexes = (o.select(k, F.explode(F.array(idx(0, "heap_", 0, F.lit(0), F.lit(0), F.lit(0)),
                                             idx(1, "pk_", 1, pk, F.lit(0), pk),
                                             idx(2, "uq_", 2, F.lit(0), uq, uq))).alias("_i"))
               .select(k.alias("object_id"), "_i.*", _db_name(k).alias("DatabaseName"), *_db_keys(k)))

    source_db = (objects.select("ClientName", "ServerName", "DatabaseName", "database_id").distinct()
                 .select("ClientName", "ServerName", "DatabaseName",
                         F.concat(F.lit("SA"), c("database_id").cast("string")).alias("SourceAbbreviation"),
                         F.when(c("database_id") == 1, "ERP").otherwise("CRM").alias("SourceSystemName"),
                         F.lit("lake").alias("DataLakeName"), F.lit("sql").alias("SourceDataStructure")))

    n = c("n_nationkey")
    src = F.when(n % 2 == 0, "ERP").otherwise("CRM")
    none = F.lit(None).cast("string")
    delta_columns = n_.select(
        src.alias("SourceName"),
        F.when(n % 3 == 0, none).otherwise(F.concat(F.lit("T"), n.cast("string"))).alias("TableName"),
        F.concat(F.lit("col "), (n % 7 + 1).cast("string")).alias("DeltaColumn"),
        F.when(n % 4 == 1, F.concat(F.lit("client"), (n % 3).cast("string"))).otherwise(none).alias("ClientName"),
        F.concat(F.lit("db"), (n % 2 + 1).cast("string")).alias("DatabaseName"),
        F.concat(F.lit("srv"), (n % 2).cast("string")).alias("ServerName"))
    ex_key = n * 2 + n % 2
    exclusions = n_.select(
        src.alias("SourceName"), F.concat(F.lit("T"), ex_key.cast("string")).alias("TableNameForExclusion"),
        F.when(n % 5 == 0, F.concat(F.lit("col "), (n % 7 + 1).cast("string"))).otherwise(none)
        .alias("ColumnNameForExclusion"),
        F.when(n % 3 == 0, F.concat(F.lit("client"), (ex_key % 3).cast("string"))).otherwise(none).alias("ClientName"))
    in_key = n * 6 + 1
    # Tables of client1 in the CRM source (keys 6n + 1 are odd and = 1 mod 3).
    inclusions = n_.select(
        F.when(in_key % 2 == 1, "CRM").otherwise("ERP").alias("SourceName"),
        F.concat(F.lit("client"), (in_key % 3).cast("string")).alias("ClientName"),
        F.concat(F.lit("T"), in_key.cast("string")).alias("TableNameForInclusion"),
        F.when(n % 4 == 0, F.lit(9)).otherwise(in_key % 4).cast("int").alias("SchemaId"))
    return {"objects": objects, "schemas": schemas, "tables": tables, "columns": columns,
            "info_columns": info_columns, "partitions": partitions, "indexes": indexes,
            "index_columns": index_columns, "source_db": source_db, "delta_columns": delta_columns,
            "exclusions": exclusions, "inclusions": inclusions}
