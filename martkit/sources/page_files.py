"""Landed response files as VARIANT pages, with a channel for the bad ones.

A page is read once, as bytes, and parsed to a VARIANT: nothing is inferred, so a
column's type does not depend on what a day's pages happen to hold. A page that is
not JSON (cut off, empty, an HTML error), or that has no list of rows, is *rejected*:
it is named with its reason instead of giving no rows in silence.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NOT_JSON = "not JSON"
PAGE_FILE, BODY = "page_file", "body"
_FILE_COLUMNS = {"path", "modificationTime", "length", "content"}


def page_files(spark: SparkSession, path: str) -> DataFrame:
    """(page_file, file_name, <folder columns>, body): one row per landed file, empty files too."""
    files = spark.read.format("binaryFile").load(path)
    folders = [c for c in files.columns if c not in _FILE_COLUMNS]
    return files.select(F.col("path").alias(PAGE_FILE), F.col("_metadata.file_name").alias("file_name"), *folders,
                        F.col("content").cast("string").alias(BODY))


def _item(field: str) -> str:
    return "$['" + field.replace("\\", "\\\\").replace("'", "\\'") + "']"


def parse_pages(df: DataFrame, field: str, body: str = BODY) -> DataFrame:
    """``df`` without its ``body``, with ``page`` (VARIANT), ``items`` and ``rejected``.

    ``items`` is the page's list ``field`` as an array of VARIANT; ``rejected`` is the
    reason why a page has none (a page whose list is JSON null counts as having none).
    """
    others = [c for c in df.columns if c != body]
    parsed = df.select(*others, F.try_parse_json(F.col(body)).alias("page"))
    items = parsed.withColumn("items", F.try_variant_get("page", _item(field), "array<variant>"))
    reason = F.when(F.col("page").isNull(), NOT_JSON).when(F.col("items").isNull(), f"no {field!r} list")
    return items.withColumn("rejected", reason)


def text_shape(kind: T.DataType) -> T.DataType:
    """The same nesting with every leaf as text: scalars as their text, lists and mixed values as JSON text."""
    if isinstance(kind, T.StructType) and kind.fields:
        return T.StructType([T.StructField(f.name, text_shape(f.dataType)) for f in kind.fields])
    return T.StringType()


def shape_of(rows: DataFrame, column: str) -> T.StructType:
    """The fields of a VARIANT column's objects, as :func:`text_shape`; no field if there are no objects.

    One aggregate (combined before the shuffle). A field that is an object in one row and
    a scalar in another is mixed, and becomes text that keeps both.
    """
    found = rows.agg(F.schema_of_variant_agg(column)).first()[0]
    # the names are quoted where they could hold this word
    ddl = "".join(part if part.startswith("`") else part.replace("OBJECT<", "STRUCT<")
                  for part in re.split(r"(`(?:[^`]|``)*`)", found))
    kind = T.StructType.fromDDL(f"x {ddl}")[0].dataType
    return text_shape(kind) if isinstance(kind, T.StructType) else T.StructType()


def ddl(kind: T.DataType) -> str:
    """The type as text, every name quoted."""
    if isinstance(kind, T.StructType):
        return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {ddl(f.dataType)}" for f in kind.fields) + ">"
    if isinstance(kind, T.ArrayType):
        return f"array<{ddl(kind.elementType)}>"
    return kind.simpleString()


def typed(column: str, schema: T.StructType) -> Column:
    """A VARIANT object as a struct of ``schema``; a value that does not fit its type is NULL."""
    return F.try_variant_get(column, "$", ddl(schema))


def unfit(column: str, schema: T.StructType) -> Column:
    """How many top-level fields of a VARIANT object hold a value that does not fit their type."""
    lost = [F.try_variant_get(column, _item(f.name), "variant").isNotNull()
            & ~F.is_variant_null(F.try_variant_get(column, _item(f.name), "variant"))
            & F.try_variant_get(column, _item(f.name), ddl(f.dataType)).isNull() for f in schema.fields]
    return sum((x.cast("int") for x in lost), F.lit(0))
