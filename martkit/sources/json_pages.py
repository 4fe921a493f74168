"""Landed JSON pages: envelopes, page chains, appends."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions.text import as_col
from martkit.sources.page_files import PAGE_FILE, ddl, page_files, parse_pages, typed


def read_envelope(spark: SparkSession, path: str, field: str, item_schema: T.StructType,
                  extra: T.StructType | None = None, keep_rejected: bool = False) -> DataFrame:
    """Read landed response files whose rows sit in a list under ``field``
    (e.g. ``value``) and return one row per list element.

    The schema is given, never inferred, so a page without some key gives
    NULL for it.  ``extra`` top-level fields (e.g. a continuation link)
    are kept next to the rows.  A page that is not JSON or has no such list fails
    the job when its rows are read; with ``keep_rejected`` it gives one row instead, with its
    file and reason in ``page_file`` and ``rejected`` (NULL on the rows of good pages).
    """
    pages = parse_pages(page_files(spark, path), field)
    outer = [F.try_variant_get("page", f"$['{f.name}']", ddl(f.dataType)).alias(f.name) for f in (extra.fields if extra else [])]
    names = [f.name for f in (extra.fields if extra else [])]
    if keep_rejected:
        items = F.when(F.col("rejected").isNull(), F.col("items")).otherwise(F.array(F.lit(None).cast("variant")))
        names += [PAGE_FILE, "rejected"]
        outer += [F.col(PAGE_FILE), F.col("rejected")]
    else:
        message = F.concat(F.col(PAGE_FILE), F.lit(": "), F.col("rejected"))
        items = F.when(F.col("rejected").isNull(), F.col("items")).otherwise(F.raise_error(message).cast("array<variant>"))
    rows = pages.select(*outer, F.explode(items).alias("_row"))
    return rows.select(*names, typed("_row", item_schema).alias("_e")).select(*names, "_e.*")


def explode_envelope(df: DataFrame, text_col: str, field: str, item_schema: T.StructType,
                     keep: list[str], pos_name: str = "pos") -> DataFrame:
    """Same as :func:`read_envelope` for JSON text held in a column:
    ``from_json`` then ``posexplode`` of the list (0-based position)."""
    env = T.StructType([T.StructField(field, T.ArrayType(item_schema))])
    parsed = df.select(*keep, F.from_json(F.col(text_col), env).alias("_env"))
    return (parsed.select(*keep, F.posexplode(F.col(f"_env.{field}")).alias(pos_name, "_e"))
            .select(*keep, pos_name, "_e.*"))


def pages_until_error(df: DataFrame, chain: list[str], page_no: str, ok: Column, has_next: Column,
                      first_page: int = 1, complete_name: str = "complete") -> DataFrame:
    """Pages of each chain up to where a client that follows links would stop.

    A chain starts at ``first_page``. It ends before its first page that is
    not ``ok`` (NULL counts as not ok), at its first page without a next link,
    or before a missing page number. Pages behind the end are dropped; a chain
    without its first page keeps nothing. ``complete`` is true only if the last
    kept page has no next link. A page number that occurs several times counts
    as failed, or as last, if any of its rows does.

    Every page also asks for the number behind its own: a number that is asked for but
    not there is a gap. So one aggregate per (chain, number) and one per chain, both
    combined before their shuffles, give the end, which is joined back; a chain holding a
    third of all rows is never gathered into one task.
    """
    good, more = F.coalesce(ok, F.lit(False)), F.coalesce(has_next, F.lit(False))
    number = F.col(page_no)
    names = [f"_k{i}" for i in range(len(chain))]
    own = F.struct(number.alias("no"), F.lit(True).alias("there"), (~good).alias("failed"), (good & ~more).alias("last"))
    behind = F.struct((number + 1).alias("no"), F.lit(False).alias("there"), F.lit(False).alias("failed"), F.lit(False).alias("last"))
    marks = df.select(*[F.col(c).alias(k) for c, k in zip(chain, names)], F.explode(F.array(own, behind)).alias("_m"))
    numbers = marks.groupBy(*names, F.col("_m.no").alias("_no")).agg(
        *[F.max(f"_m.{x}").alias(f"_{x}") for x in ("there", "failed", "last")])
    ends = numbers.groupBy(*[F.col(k).alias(f"_e{k}") for k in names]).agg(
        F.min(F.when(F.col("_there"), F.col("_no"))).alias("_first"),
        F.min(F.when(F.col("_last"), F.col("_no"))).alias("_last"),
        F.least(F.min(F.when(F.col("_failed"), F.col("_no") - 1)), F.min(F.when(F.col("_last"), F.col("_no"))),
                F.min(F.when(~F.col("_there"), F.col("_no") - 1))).alias("_end"))
    match = [F.col(c).eqNullSafe(F.col(f"_e{k}")) for c, k in zip(chain, names)]
    kept = df.join(ends, match).filter((F.col("_first") == first_page) & (number <= F.col("_end")))
    return kept.select(*df.columns, F.coalesce(F.col("_end") == F.col("_last"), F.lit(False)).alias(complete_name))


def union_pages(pages: list[DataFrame]) -> DataFrame:
    """Bag union of pages by column name; keys missing from a page are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def from_json_col(c, schema: T.DataType | str) -> Column:
    """Decode a JSON text column with a fixed schema."""
    return F.from_json(as_col(c), schema)
