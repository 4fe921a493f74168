"""Control statements: one row per source table with generated SQL text.

Inputs are catalog extracts of source databases (FIXTURES.md section 2);
every catalog table carries ``database_id``, ``ServerName`` and
``ClientName``.  The output has one row per table with a select
statement, a key-only select statement, a key match clause, staging file
names, an active flag and the delta column.

Plan notes: everything keyed by the table alone is joined at table grain; the
entries of the best indexes are counted per column and joined to the columns while
these are narrow; then tables, columns and positions, the largest inputs, are joined one
after the other by equi-joins (no lists, no windows), and what a row takes along is what
is still needed. Ordered texts are built in chunks of column positions. The lookup lists are small
and Spark broadcasts them by size.  "One best index per table" is an aggregate;
"has no key column" is one flag per name, combined before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from martkit.functions.text import (
    bracket, concat_blank, concat_strict, fold_case, underscore_spaces, without_case,
)
from martkit.operators.aggregates import group_ordered_texts, sum_nonzero
from martkit.operators.joins import (
    best_row_per_key, left_join_distinct, left_lookup, listed_flag, require_unique,
)
from martkit.sources.sinks import staging_name

# ---------------------------------------------------------------------------
# Text layout of the generated statements and the output
# columns.  They must equal the original's for equal text.
SELECT_HEAD = "SELECT \n\t\t"
SELECT_SEP = "\n\t\t, "
KEY_SELECT_SEP = "\n        , "
SERVER_PART = (" \n\t\t, '", "' AS [SourceServerName] ")
DATABASE_PART = ("\n\t\t, '", "' AS [SourceDatabaseName] ")
FROM_PART = ("\n\t FROM [", "].")
NOLOCK = " WITH (NOLOCK)"
MERGE_HEAD = "\n\t\t"
MERGE_SEP = "\n\t\t\tAND "
MERGE_TAIL = "\n\t\t\t"
USER_TABLE = "USER_TABLE"
SEQUENCE_NUMBER = 100
OUTPUT_COLUMNS = [
    "ClientName", "DataLakeName", "SourceDataStructure", "SourceSystemName", "SourceServerName",
    "SourceDatabaseName", "SourceSchemaName", "SourceTableName", "SourceRowCount",
    "SourceSelectStatement", "SourceSelectPKStatement", "PrimaryKeyMergeStatement",
    "StagingDataFileName", "PrimaryKeyFileName", "IsTableConsideredActive", "IsDelta",
    "DeltaColumn", "DeltaValue", "SequenceNumber",
]
# ---------------------------------------------------------------------------

#: Column positions whose texts are built together; a wider table takes several tasks.
CHUNK_COLUMNS = 256
DB_KEYS = ["database_id", "ServerName", "ClientName"]
#: Names whose spelling the result shows, by input, where names are compared without regard to case.
SHOWN_NAMES = {
    "schemas": ["name"], "tables": ["name"], "columns": ["name"], "delta_columns": ["DeltaColumn"],
    "source_db": ["ClientName", "ServerName", "DatabaseName", "SourceSystemName", "DataLakeName", "SourceDataStructure"],
}


def statement_text(select_list: Column, server: Column, database: Column, schema_table: Column) -> Column:
    """Full select statement; any NULL piece (``+`` concatenation) makes it NULL."""
    return concat_strict(SELECT_HEAD, select_list, SERVER_PART[0], server, SERVER_PART[1],
                         DATABASE_PART[0], database, DATABASE_PART[1], FROM_PART[0], database,
                         FROM_PART[1], schema_table, NOLOCK)


def select_item(formatted: Column) -> Column:
    """``[col] AS [col_with_underscores]``; NULL pieces count as empty."""
    return concat_blank(formatted, " AS ", underscore_spaces(formatted))


def merge_text(clause_list: Column) -> Column:
    return concat_blank(MERGE_HEAD, clause_list, MERGE_TAIL)


def control_columns(objects: DataFrame, schemas: DataFrame, tables: DataFrame, columns: DataFrame,
                    info_columns: DataFrame, partitions: DataFrame, indexes: DataFrame,
                    index_columns: DataFrame, source_db: DataFrame, delta_columns: DataFrame,
                    exclusions: DataFrame, inclusions: DataFrame, check_lookups: bool = False,
                    case_insensitive: bool = False) -> DataFrame:
    """One row per column of every user table, with all lookups and flags; nothing is dropped yet.

    ``case_insensitive``: names are folded and so compared without regard to case; ``<column>_shown`` has the spelling
    of those that the result shows.
    """
    c = F.col
    user_table = USER_TABLE
    if case_insensitive:
        user_table = fold_case(F.lit(USER_TABLE))
        objects, partitions, indexes, index_columns, info_columns, exclusions, inclusions = [
            without_case(df) for df in (objects, partitions, indexes, index_columns, info_columns, exclusions, inclusions)]
        # Names of the large inputs move as spelt and are folded where they are compared.
        schemas, tables, columns = [without_case(df, late=SHOWN_NAMES[name]) for name, df in (
            ("schemas", schemas), ("tables", tables), ("columns", columns))]
        delta_columns, source_db = [without_case(df, SHOWN_NAMES[name]) for name, df in (
            ("delta_columns", delta_columns), ("source_db", source_db))]

    def spelt(names: dict[str, str]) -> dict[str, str]:
        """``names`` for :func:`left_lookup`: the spelling alone, if that is kept apart."""
        return {f"{new}_shown": f"{name}_shown" for new, name in names.items()} if case_insensitive else names

    def folded(df: DataFrame, name: str, new: str | None = None) -> DataFrame:
        """``df`` with a name as it is compared."""
        if case_insensitive:
            return df.withColumn(new or name, fold_case(f"{name}_shown"))
        return df.withColumn(new, c(name)) if new else df

    if check_lookups:
        delta_columns = require_unique(delta_columns, ["SourceName", "TableName", "DeltaColumn", "ClientName",
                                                       "DatabaseName", "ServerName"], "delta columns")
        exclusions = require_unique(exclusions, ["SourceName", "TableNameForExclusion", "ColumnNameForExclusion",
                                                 "ClientName"], "exclusions")
        inclusions = require_unique(inclusions, ["SourceName", "ClientName", "TableNameForInclusion", "SchemaId"],
                                    "inclusions")
    o = objects.filter(c("type_desc") == user_table)

    # Row counts per table from heap / clustered partitions only; zero-row
    # tables drop out here and count as 0 later.
    p = sum_nonzero(partitions.filter(c("index_id") < 2), ["object_id"] + DB_KEYS, "rows", "rows")

    # Best unique index per table: primary key, then unique constraint, then
    # unique index, then lowest index id.
    rank = (F.when(c("is_primary_key") == 1, 1).when(c("is_unique_constraint") == 1, 2)
            .when(c("is_unique") == 1, 3).otherwise(4))
    idx = indexes.filter((c("type") != 0) & (c("is_unique") == 1))
    best = best_row_per_key(idx, ["object_id", "DatabaseName", "ServerName", "ClientName"],
                            [rank, c("index_id")], ["index_id", "name", "database_id"])

    db_names = ["ClientName", "ServerName", "database_id", "DatabaseName", "SourceAbbreviation",
                "SourceSystemName", "DataLakeName", "SourceDataStructure"]
    if case_insensitive:                 # entries that differ in spelling only are one
        spellings = [f"{name}_shown" for name in SHOWN_NAMES["source_db"]]
        source_db = source_db.groupBy(*[name for name in db_names if name != "database_id"]).agg(
            *[F.min(name).alias(name) for name in spellings])
        db_names = db_names + spellings
    dbs = left_join_distinct(
        source_db, objects,
        [("ServerName", "ServerName"), ("ClientName", "ClientName"), ("DatabaseName", "DatabaseName")],
        {"database_id": "database_id"}, db_names)

    if check_lookups:
        dbs = require_unique(dbs, ["ClientName", "ServerName", "DatabaseName"], "database ids")
        dbs = require_unique(dbs, ["ClientName", "ServerName", "database_id"], "database names")

    by_object = ["object_id"] + DB_KEYS
    own = [(c(k), k) for k in by_object]
    obj_on = own[1:]

    # Entries of each column in the best indexes of its object (one, unless the object has several database names), and
    # how many of these indexes have it; added to the columns before these meet their tables.
    entries = index_columns.select(*by_object, "index_id", "column_id").join(
        best.select(*by_object, "index_id", "DatabaseName"), by_object + ["index_id"])
    entries = (entries.repartition(*by_object, "column_id")
               .groupBy(*by_object, "column_id", "DatabaseName").agg(F.count(F.lit(1)).alias("entries"))
               .groupBy(*by_object, "column_id").agg(F.sum("entries").alias("entries"), F.count(F.lit(1)).alias("indexes")))
    [name] = spelt({"name": "name"}).values()
    cols = left_lookup(columns.select(*by_object, "column_id", name), entries, own + [(c("column_id"), "column_id")],
                       {"entries": "entries", "indexes": "indexes"})

    # Table grain first: every lookup keyed by the table alone runs before
    # the join that fans out to one row per column (left joins whose
    # conditions only use earlier tables commute, so the rows are the same).
    t = o.select("object_id", "schema_id", "DatabaseName", *DB_KEYS)
    t = left_lookup(t, tables, own, spelt({"t_name": "name"}) | {
        "t_DatabaseName": "DatabaseName", "t_ClientName": "ClientName", "t_ServerName": "ServerName"})

    # "No key column" is decided per (client, server, database, table name) of the catalog table row, across
    # schemas: some column of a table of that name belongs to its best index. One flag per object, combined per name
    # before the shuffle and joined back (objects without a catalog table row share the NULL name), so no name is
    # gathered in one task. The count looks at the name as well, so that Spark moves the columns once for both uses.
    keyed = cols.groupBy(*by_object, "column_id").agg(F.count(F.when(c("entries") > 0, F.struct(name))).alias("_keys"))
    keyed = keyed.filter("_keys > 0").select(*by_object, F.lit(1).alias("_keyed")).distinct()
    name_keys = ["_t_name", "t_DatabaseName", "t_ServerName", "t_ClientName"]
    t = folded(t, "t_name", "_t_name")
    by_name = left_lookup(t, keyed, own, {"_keyed": "_keyed"})
    by_name = by_name.groupBy(*name_keys).agg(F.max("_keyed").alias("_named_key"))
    t = left_lookup(t, by_name, [(c(k), k) for k in name_keys], {"_named_key": "_named_key"}, null_safe=True)
    t = t.withColumn("HasNoPK", F.when(c("_named_key") == 1, 0).otherwise(1)).drop("_named_key", *name_keys)

    t = left_lookup(t, p, own, {"p_rows": "rows"})
    t = left_lookup(t, best.groupBy(*by_object).agg(F.count(F.lit(1)).alias("n")), own, {"_best": "n"})
    t = folded(t, "t_name")
    t = left_lookup(t, dbs, obj_on, {"d_database_id": "database_id", "d_SourceSystemName": "SourceSystemName",
                                     "d_ServerName": "ServerName", "d_ClientName": "ClientName"} | spelt(
        {f"d_{name}": name for name in SHOWN_NAMES["source_db"]}))
    t = folded(left_lookup(t, schemas, [(c("schema_id"), "schema_id")] + obj_on,
                           {"s_schema_id": "schema_id"} | spelt({"s_name": "name"})), "s_name")

    # Block list for whole tables, general or per client.
    src, tname = c("d_SourceSystemName"), c("t_name")
    ex = exclusions
    t = listed_flag(t, [
        (ex, [(src, "SourceName"), (tname, "TableNameForExclusion")], "TableNameForExclusion",
         c("ClientName").isNull() & c("ColumnNameForExclusion").isNull()),
        (ex, [(src, "SourceName"), (tname, "TableNameForExclusion"), (c("ClientName"), "ClientName")],
         "TableNameForExclusion", c("ColumnNameForExclusion").isNull()),
    ], "_blocked_table")

    # Allow list, open by default: applies only where the (client, source)
    # pair has any entry.
    pairs = inclusions.select("ClientName", "SourceName").distinct().withColumn("_pair", F.lit(1))
    t = left_lookup(t, inclusions, [(src, "SourceName"), (c("ClientName"), "ClientName"),
                                    (tname, "TableNameForInclusion"), (c("s_schema_id"), "SchemaId")],
                    {"_included": "TableNameForInclusion"})
    t = left_lookup(t, pairs, [(c("ClientName"), "ClientName"), (src, "SourceName")], {"_pair": "_pair"})
    not_allowed = c("_included").isNull() & c("_pair").isNotNull()
    t = t.withColumn("ExcludeTable", F.when((c("_blocked_table") == 1) | not_allowed, 1).otherwise(0))

    # Column grain: one row per column, per entry it has in each best index (none: one row with NULL) and per position
    # listed for its name (none: one row with NULL).
    t = folded(left_lookup(t, cols, own, {"c_column_id": "column_id", "_entries": "entries", "_indexes": "indexes"}
                           | spelt({"c_name": "name"})), "c_name")
    found = F.coalesce(c("_entries"), F.lit(0)).cast("int")
    without = (F.coalesce(c("_best"), F.lit(1)) - F.coalesce(c("_indexes"), F.lit(0))).cast("int")
    t = t.withColumn("_entry", F.explode(F.concat(F.array_repeat(F.lit(True), found), F.array_repeat(F.lit(False), without))))
    t = t.withColumn("ic_column_id", F.when(c("_entry"), c("c_column_id"))).drop("_entry", "_entries", "_indexes", "_best")

    # Delta column: client-specific, then table-specific, then general.
    col_name = F.trim(c("c_name"))
    dc = delta_columns

    def delta(name: str) -> dict[str, str]:
        return {name: "DeltaColumn"} | ({f"{name}_shown": "DeltaColumn_shown"} if case_insensitive else {})
    t = left_lookup(t, dc, [(src, "SourceName"), (col_name, "DeltaColumn")], delta("_gdc"),
                    right_filter=c("TableName").isNull() & c("ClientName").isNull())
    t = left_lookup(t, dc, [(src, "SourceName"), (col_name, "DeltaColumn"), (tname, "TableName")],
                    delta("_tdc"), right_filter=c("ClientName").isNull())
    t = left_lookup(t, dc, [(src, "SourceName"), (col_name, "DeltaColumn"), (tname, "TableName"),
                            (c("ClientName"), "ClientName"), (c("DatabaseName"), "DatabaseName"),
                            (c("ServerName"), "ServerName")], delta("_cdc"))
    t = t.withColumns({f"DeltaColumn{x}": F.coalesce(f"_cdc{x}", f"_tdc{x}", f"_gdc{x}")
                       for x in (["", "_shown"] if case_insensitive else [""])})

    # Block list for single columns, general or per client.
    t = listed_flag(t, [
        (ex, [(src, "SourceName"), (tname, "TableNameForExclusion"), (col_name, "ColumnNameForExclusion")],
         "ColumnNameForExclusion", c("ClientName").isNull()),
        (ex, [(src, "SourceName"), (tname, "TableNameForExclusion"), (col_name, "ColumnNameForExclusion"),
              (c("ClientName"), "ClientName")], "ColumnNameForExclusion", None),
    ], "ExcludeColumn")

    # Positions come last: their join moves the rows by name, without what the lookups above needed.
    return left_lookup(t, info_columns, [(c("t_name"), "TABLE_NAME"), (c("c_name"), "COLUMN_NAME"),
                                         (c("s_name"), "TABLE_SCHEMA"), (c("d_database_id"), "database_id"),
                                         (c("d_ServerName"), "ServerName"), (c("d_ClientName"), "ClientName")],
                       {"OrdinalPosition": "ORDINAL_POSITION"})


def drop_metrics() -> list[Column]:
    """What the control table leaves out or cannot look up, counted over the rows of :func:`control_columns`."""
    def rows(condition: Column, name: str) -> Column:
        return F.count_if(condition).alias(name)

    c, named = F.col, F.col("c_name").isNotNull()
    return [F.count(F.lit(1)).alias("column_rows"), rows(~named, "tables_without_columns"),
            rows(c("ExcludeColumn") != 0, "excluded_columns"), rows(named & c("OrdinalPosition").isNull(), "columns_without_position"),
            rows(c("t_name").isNull(), "rows_without_table"), rows(c("s_name").isNull(), "rows_without_schema"),
            rows(c("d_SourceSystemName").isNull(), "rows_without_source"), rows(c("ExcludeTable") == 1, "rows_of_inactive_tables")]


def control_statements(objects: DataFrame, schemas: DataFrame, tables: DataFrame, columns: DataFrame,
                       info_columns: DataFrame, partitions: DataFrame, indexes: DataFrame,
                       index_columns: DataFrame, source_db: DataFrame, delta_columns: DataFrame,
                       exclusions: DataFrame, inclusions: DataFrame, check_lookups: bool = False,
                       case_insensitive: bool = False, observation: Observation | None = None) -> DataFrame:
    """The control table, one row per (client, database, schema, table).

    A lookup entry that occurs twice repeats the columns it matches in the
    generated text; ``check_lookups`` fails the job instead (delta columns,
    block list, allow list, and one id per database name).

    ``case_insensitive``: names that differ in case only are equal in every lookup, group and
    comparison (as in the original's database); which spelling a group shows is then open.
    They are compared in folded case and shown as spelt. ``observation`` receives :func:`drop_metrics` while the result is
    computed, without a pass of its own.
    """
    c = F.col
    t = control_columns(objects, schemas, tables, columns, info_columns, partitions, indexes, index_columns, source_db,
                        delta_columns, exclusions, inclusions, check_lookups, case_insensitive)
    x = "_shown" if case_insensitive else ""
    if observation is not None:
        t = t.observe(observation, *drop_metrics())
    # A table without columns has one row here without a column name, which would
    # give the invalid text " AS ": it adds no item, and the table stays with NULL texts.
    t = t.filter(c("ExcludeColumn") == 0)
    groups = {"g_SourceTableName": "t_name", "g_SourceSchemaName": "s_name", "g_SourceServerName": "d_ServerName",
              "g_SourceDatabaseName": "d_DatabaseName", "g_ClientName": "d_ClientName", "g_DataLakeName": "d_DataLakeName",
              "g_SourceDataStructure": "d_SourceDataStructure", "g_SourceSystemName": "d_SourceSystemName"}
    t = t.select(
        *[c(f"{name}{x}").alias(g) for g, name in groups.items()], c("p_rows").alias("g_SourceRowCount"),
        c("ExcludeTable").alias("g_ExcludeTable"), c("HasNoPK").alias("g_HasNoPK"), c(f"c_name{x}").alias("_name"),
        c("ic_column_id").isNotNull().alias("_is_key"), c("OrdinalPosition").alias("_ord"),
        c("c_column_id").alias("_colid"), c(f"DeltaColumn{x}").alias("_delta"))
    # Per-column pieces, built where the texts are: a row moves with its name alone.
    name, has_key_col = c("_name"), c("_is_key")
    key_column = F.when(has_key_col, concat_blank("[", name, "]"))
    clause = F.when(has_key_col, concat_blank("t.", name, " = s.", name))
    items = {"_sel": (F.when(name.isNotNull(), select_item(bracket(name))), SELECT_SEP),
             "_keys": (F.when(key_column.isNotNull(), select_item(key_column)), KEY_SELECT_SEP),
             "_clauses": (clause, MERGE_SEP)}
    # the greatest name, as spelt
    delta = F.struct(fold_case("_delta").alias("name"), c("_delta").alias("shown")) if case_insensitive else c("_delta")
    # One row per (client, source, server, database, schema, table, row
    # count, flags).  The schema-table text and the staging file names are
    # functions of schema and table name, so they are derived after the
    # aggregation instead of being part of the (wide) grouping key. The table name comes first, as rows that
    # differ in the first sort key are told apart without a look at the others.
    group_cols = [*groups, "g_SourceRowCount", "g_ExcludeTable", "g_HasNoPK"]
    # Column order: ordinal position, then column id so equal positions (e.g. missing ones) still give one
    # repeatable text.  Texts are built in chunks of that order: missing positions come first, by column id.
    chunk = F.coalesce(F.floor(c("_ord") / CHUNK_COLUMNS), F.floor(c("_colid") / CHUNK_COLUMNS) - (1 << 40),
                       F.lit(-(1 << 41)).cast("long"))
    g = group_ordered_texts(t, group_cols, items, [c("_ord"), c("_colid")], chunk, maxes={"_max_delta": delta},
                            compared={g: fold_case(g) for g in groups} if case_insensitive else None)
    if case_insensitive:
        g = g.withColumn("_max_delta", c("_max_delta.shown"))
    schema, table = c("g_SourceSchemaName"), c("g_SourceTableName")
    g = g.withColumns({"g_SchemaTable": concat_strict("[", schema, "].[", table, "]"),
                       "g_StagingDataFileName": staging_name(schema, table),
                       "g_PrimaryKeyFileName": staging_name(schema, table, primary_key=True)})
    row_count = F.coalesce(c("g_SourceRowCount"), F.lit(0))
    return g.select(
        c("g_ClientName").alias("ClientName"), c("g_DataLakeName").alias("DataLakeName"),
        c("g_SourceDataStructure").alias("SourceDataStructure"),
        c("g_SourceSystemName").alias("SourceSystemName"), c("g_SourceServerName").alias("SourceServerName"),
        c("g_SourceDatabaseName").alias("SourceDatabaseName"), c("g_SourceSchemaName").alias("SourceSchemaName"),
        c("g_SourceTableName").alias("SourceTableName"), row_count.alias("SourceRowCount"),
        statement_text(c("_sel"), c("g_SourceServerName"), c("g_SourceDatabaseName"), c("g_SchemaTable"))
        .alias("SourceSelectStatement"),
        statement_text(c("_keys"), c("g_SourceServerName"), c("g_SourceDatabaseName"), c("g_SchemaTable"))
        .alias("SourceSelectPKStatement"),
        F.when(c("g_HasNoPK") == 0, merge_text(c("_clauses"))).alias("PrimaryKeyMergeStatement"),
        c("g_StagingDataFileName").alias("StagingDataFileName"),
        F.when(c("g_HasNoPK") == 0, c("g_PrimaryKeyFileName")).alias("PrimaryKeyFileName"),
        F.when((c("g_ExcludeTable") == 1) | (row_count == 0), 0).otherwise(1).alias("IsTableConsideredActive"),
        F.when(c("_max_delta").isNull(), 0).otherwise(1).alias("IsDelta"),
        c("_max_delta").alias("DeltaColumn"),
        F.lit(None).cast("string").alias("DeltaValue"),
        F.lit(SEQUENCE_NUMBER).alias("SequenceNumber"))
