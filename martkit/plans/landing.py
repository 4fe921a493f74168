"""Landing of paged JSON responses as cleaned, dated Parquet.

The HTTP client and token exchange are outside Spark; these jobs start at
response pages already landed as JSON files (one response per file), which
is where a Spark job takes over:

* :func:`land_endpoint`: rows under ``value`` -> flattened, cleaned,
  stamped Parquet (skipped when there are no rows).
* :func:`active_datasets`: datasets of active workspaces (semi join).
* :func:`land_details`: detail responses landed per dataset
  (``.../dataset_id=<id>/*.json`` or ``.../<id>.json``), restricted to active
  datasets, nested objects kept, stamped with the dataset id.
* :func:`land_activity`: activity pages landed per day
  (``.../load_day=YYYYMMDD/*.json`` with ``page_no``, ``status_code``,
  ``activityEventEntities``, ``continuationUri``): each day's chain is
  followed by its links, the fixed 25 fields are kept, the window bounds are
  added, and every day goes to its own dated folder.  A day whose chain is not
  complete goes to ``<out>_incomplete`` and replaces no complete day.
* :func:`audit_days`: which expected days are complete, incomplete or absent.

Pages are parsed as VARIANT (:mod:`martkit.sources.page_files`): no type is inferred, and a
page that cannot be read is reported and listed, never dropped in silence.
Every landed row is kept: there is no row limit, and no day is left out.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions.dates import ts_text
from martkit.operators.joins import semi_by_keys
from martkit.operators.shape import clean_column_names, flatten_structs, stamp_load_date, strict_select
from martkit.sources.json_pages import pages_until_error
from martkit.sources.page_files import BODY, PAGE_FILE, ddl, page_files, parse_pages, shape_of, typed, unfit
from martkit.sources.sinks import discard, write_counted, write_if_any, write_parquet

# The activity fields kept, in order, and the page field names.
ACTIVITY_FIELDS = [
    "Id", "RecordType", "CreationTime", "Operation", "OrganizationId", "UserType", "UserKey", "Workload",
    "UserId", "ClientIP", "UserAgent", "Activity", "ItemName", "WorkSpaceName", "DatasetName", "ReportName",
    "WorkspaceId", "ObjectId", "DatasetId", "ReportId", "IsSuccess", "ReportType", "RequestId", "ActivityId",
    "DistributionMethod",
]
ACTIVITY_LIST = "activityEventEntities"
VALUE_LIST = "value"
NEXT_LINK = "continuationUri"
#: Bad pages that a status names; all of them are in the ``_rejected`` table.
NAMED = 100

_INT_FIELDS = {"RecordType", "UserType"}
_BOOL_FIELDS = {"IsSuccess"}
ACTIVITY_SCHEMA = T.StructType([
    T.StructField(f, T.IntegerType() if f in _INT_FIELDS else T.BooleanType() if f in _BOOL_FIELDS
                  else T.StringType()) for f in ACTIVITY_FIELDS])


def rows_of(pages: DataFrame, field: str = VALUE_LIST, keep: list[str] | None = None) -> DataFrame:
    """One row per element of the list ``field``; keys missing in some rows are NULL."""
    keep = keep or []
    if field not in pages.columns:
        raise ValueError(f"no {field!r} list in the landed pages")
    rows = pages.select(*keep, F.explode(F.col(field)).alias("_row"))
    elem = pages.schema[field].dataType.elementType
    return rows.select(*keep, "_row.*") if isinstance(elem, T.StructType) else rows.withColumnRenamed("_row", field)


@dataclass(frozen=True)
class Landed:
    """What became of one endpoint's pages."""

    rows: int                   # rows landed
    pages: int                  # files found
    rejected: list[str]         # "file: reason", at most ``NAMED`` of them
    rejected_pages: int
    unfit: int                  # values that did not fit the given type, landed as NULL
    rejected_path: str

    @property
    def status(self) -> str:
        notes = []
        if self.rejected_pages:
            more = self.rejected_pages - len(self.rejected)
            notes.append(f"{self.rejected_pages} of {self.pages} pages rejected: {'; '.join(self.rejected)}"
                         + (f" and {more} more in {self.rejected_path}" if more else ""))
        if self.unfit:
            notes.append(f"{self.unfit} values did not fit their type")
        if not notes:
            return "written" if self.rows else "empty"
        return f"{'partial' if self.rows or not self._all_rejected else 'failed'}: {', '.join(notes)}"

    @property
    def _all_rejected(self) -> bool:
        return self.pages > 0 and self.rejected_pages == self.pages


def _listed(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(page_file, file_name) of every file; Spark's reader gives no row for an empty one."""
    paths = [unquote(re.sub("^file:/+", "file:/", f)) for f in files.inputFiles()]
    return spark.createDataFrame([(f, f.rpartition("/")[2]) for f in paths], f"{PAGE_FILE} string, file_name string")


def land_pages(spark: SparkSession, pages_path: str, out_path: str, run_ts: dt.datetime,
               schema: T.StructType | None = None, flatten: bool = True, skip_empty: bool = True,
               key: str | None = None, only: DataFrame | None = None) -> Landed:
    """Land the rows of one endpoint's pages; report every page that gave none.

    Pages are parsed as VARIANT, never inferred: with ``schema`` (of a page) the rows get
    its types in the one pass that writes them; without it, an aggregate finds the
    fields, and every leaf is text, so that types never depend on the day and a field that
    changes type keeps both values. Bad pages go to ``<out_path>_rejected``
    (page_file, reason); page, row and unfit counts are observed while writing.

    ``key``: the name of a column with the key of a page's rows, from its folder
    ``<key>=<value>`` or else from its file name ``<value>.json``. ``only``: keep the keys in
    this one-column DataFrame.
    """
    def chosen(files: DataFrame) -> DataFrame:
        if not key:
            return files
        folder = F.regexp_extract(PAGE_FILE, f"/{key}=([^/]+)/", 1)
        named = F.when(folder != "", folder).otherwise(F.regexp_replace("file_name", r"\.[^.]*$", ""))
        files = files.select(*[c for c in files.columns if c in (PAGE_FILE, BODY)], named.alias(key))
        return files if only is None else files.join(only.select(F.col(only.columns[0]).cast("string").alias(key)), key, "left_semi")

    all_files = page_files(spark, pages_path)
    files, keep = chosen(all_files), [key] if key else []
    parsed = parse_pages(files, VALUE_LIST)
    if schema is None:
        shape = shape_of(parsed.select(F.explode("items").alias("_row")), "_row")
    elif VALUE_LIST in schema.names:
        shape = schema[VALUE_LIST].dataType.elementType
    else:
        raise ValueError(f"no {VALUE_LIST!r} list in the page schema")
    pages = Observation()
    seen = parsed.observe(pages, F.count(F.lit(1)).alias("pages"), F.count("rejected").alias("rejected"))
    rows = seen.select(*keep, F.explode("items").alias("_row"))
    lost = unfit("_row", shape) if schema is not None else F.lit(0)
    values = rows.select(*keep, typed("_row", shape).alias("_value"), lost.alias("_unfit"))
    total = Observation()
    counted = values.observe(total, F.sum("_unfit").alias("unfit"))
    # a key given by the page's place comes last, and wins over a field of that name
    fields = [F.col("_value").getField(f.name).alias(f.name) for f in shape.fields if f.name not in keep]
    out = tidy(counted.select(*fields, *keep), run_ts, flatten)
    if skip_empty:
        count = write_counted(out, out_path)["rows"]
    else:
        whole = Observation()
        write_parquet(out.observe(whole, F.count(F.lit(1)).alias("rows")), out_path)
        count = whole.get["rows"]
    found, rejected, bad_pages = pages.get, [], 0
    listed = chosen(_listed(spark, all_files))
    n_files = listed.count()
    if found["rejected"] or n_files > found["pages"]:
        empty = listed.join(parsed.select(PAGE_FILE), PAGE_FILE, "left_anti").select(PAGE_FILE, F.lit("empty file"))
        bad = parsed.filter("rejected IS NOT NULL").select(PAGE_FILE, F.col("rejected").alias("reason")).union(empty)
        bad_pages = write_counted(bad, f"{out_path}_rejected")["rows"]
        named = spark.read.parquet(f"{out_path}_rejected").orderBy(PAGE_FILE).limit(NAMED)
        rejected = [f"{r[PAGE_FILE]} ({r['reason']})" for r in named.collect()]
    return Landed(count, n_files, rejected, bad_pages, total.get["unfit"] or 0, f"{out_path}_rejected")


def tidy(df: DataFrame, run_ts: dt.datetime, flatten: bool = True) -> DataFrame:
    """Flatten nested objects (optional), clean names, stamp the load date."""
    if flatten:
        df = flatten_structs(df)
    return stamp_load_date(clean_column_names(df), run_ts)


def land_endpoint(spark: SparkSession, pages_path: str, out_path: str, run_ts: dt.datetime,
                  schema: T.StructType | None = None, skip_empty: bool = True) -> bool:
    """Land every row of one endpoint's pages; returns whether anything was written.
    ``skip_empty=False`` writes an empty result too. See :func:`land_pages` for bad pages."""
    landed = land_pages(spark, pages_path, out_path, run_ts, schema, skip_empty=skip_empty)
    return landed.rows > 0 or not skip_empty


def active_datasets(groups: DataFrame, datasets: DataFrame) -> DataFrame:
    """Datasets whose workspace is active and of type Workspace."""
    for need, df in (("id", groups), ("state", groups), ("type", groups), ("workspaceId", datasets)):
        if need not in df.columns:
            raise ValueError(f"column {need!r} missing; the endpoint call probably failed")
    active = groups.filter((F.col("state") == "Active") & (F.col("type") == "Workspace"))
    return semi_by_keys(datasets, active, [("workspaceId", "id")])


def land_details(spark: SparkSession, details_path: str, datasets: DataFrame, out_path: str,
                 run_ts: dt.datetime, schema: T.StructType | None = None) -> bool:
    """Detail rows of the given datasets, nested objects kept. The dataset id comes from
    the landed folder (``dataset_id=<id>``) or else from the file name (``<id>.json``)."""
    return land_pages(spark, details_path, out_path, run_ts, schema, flatten=False, key="dataset_id",
                      only=datasets.select("id")).rows > 0


def activity_rows(pages: DataFrame, quoted: bool = True, closed_second: bool = True) -> DataFrame:
    """Activity rows of every day's page chain, up to where its links lead.

    ``pages`` has ``load_day`` (``YYYYMMDD``), ``page_no``, ``status_code``,
    the entity list and the continuation link.  The window texts follow from
    the day and have the original parameters' form (quoted, ``23:59:59`` end)
    unless told otherwise.
    """
    return _activity_rows(_activity_chain(pages), quoted, closed_second)


def _activity_chain(pages: DataFrame) -> DataFrame:
    has_next = F.col(NEXT_LINK).isNotNull() & (F.col(NEXT_LINK) != "")
    return pages_until_error(pages, ["load_day"], "page_no", F.col("status_code") == 200, has_next)


def _activity_rows(chain: DataFrame, quoted: bool = True, closed_second: bool = True) -> DataFrame:
    rows = chain.select("load_day", "complete", F.explode(ACTIVITY_LIST).alias("_e")).select(
        "load_day", "complete", "_e.*")
    rows = strict_select(rows, ["load_day", "complete"] + ACTIVITY_FIELDS)
    start = F.to_timestamp_ntz(F.col("load_day"), F.lit("yyyyMMdd"))
    end = start + F.expr("interval 23 hours 59 minutes 59 seconds" if closed_second else "interval 1 day")
    return (rows.withColumn("_start", start).withColumn("_end", end)
            .select(*rows.columns, ts_text("_start", quoted).alias("startDateTime"),
                    ts_text("_end", quoted).alias("endDateTime")))


def activity_pages(spark: SparkSession, pages_path: str) -> DataFrame:
    """(page_file, rejected, load_day, page_no, status_code, entities, link, fields) of every landed activity page.

    ``fields`` are the names of the fields that its entities have, whatever their value.
    """
    parsed = parse_pages(page_files(spark, pages_path), ACTIVITY_LIST)

    def field(name: str, kind: str) -> Column:
        return F.try_variant_get("page", f"$.{name}", kind).alias(name)

    names = F.transform("items", lambda x: F.map_keys(F.try_variant_get(x, "$", "map<string, variant>")))
    return parsed.select(
        PAGE_FILE, "rejected", F.regexp_extract(PAGE_FILE, "/load_day=([^/]+)/", 1).alias("load_day"),
        field("page_no", "int"), field("status_code", "int"),
        F.try_variant_get("page", f"$.{ACTIVITY_LIST}", f"array<{ddl(ACTIVITY_SCHEMA)}>").alias(ACTIVITY_LIST),
        field(NEXT_LINK, "string"), F.array_distinct(F.flatten(F.filter(names, lambda x: x.isNotNull()))).alias("fields"))


def chain_days(pages: DataFrame, kept: DataFrame) -> DataFrame:
    """(load_day, status) of every day with a page: ``complete`` or ``incomplete``.
    ``kept`` are the pages of :func:`pages_until_error`."""
    whole = kept.groupBy("load_day").agg(F.max("complete").alias("complete"))
    days = pages.select("load_day").distinct().join(whole, "load_day", "left")
    return days.select("load_day", F.when(F.col("complete"), "complete").otherwise("incomplete").alias("status"))


def audit_days(windows: DataFrame, days: DataFrame) -> DataFrame:
    """(load_day, status) of every expected day: ``complete``, ``incomplete`` or ``absent``.

    ``windows`` come from :func:`martkit.sources.windows.day_windows`; ``days`` (load_day, status)
    may hold several pulls of a day, of which the best counts.
    """
    landed = days.groupBy("load_day").agg(F.min("status").alias("_status"))       # complete < incomplete
    return (windows.select(F.col("load_date").alias("load_day")).join(landed, "load_day", "left")
            .select("load_day", F.coalesce("_status", F.lit("absent")).alias("status")))


def land_activity(spark: SparkSession, pages_path: str, out_base: str) -> dict[str, bool]:
    """Write each day's activity rows; returns which of the two folders were written.

    The pages are read and parsed once, into a staged table next to ``out_base``; the chains
    are followed there. Days with a complete chain go to ``out_base/load_day=YYYYMMDD``, the
    rows of broken chains to ``<out_base>_incomplete``; only the days present are replaced
    (dynamic partition overwrite), so a complete day is never replaced by a partial one.
    Every day with a page is noted in ``<out_base>_days`` (:func:`audit_days` reads it), every bad
    page in ``<out_base>_rejected``. A kept field that no landed row has fails the job.
    """
    staged = f"{out_base}_staged-{uuid.uuid4().hex}"
    seen = Observation()
    marks = [F.max(F.array_contains("fields", f)).alias(f) for f in ACTIVITY_FIELDS]
    (activity_pages(spark, pages_path).observe(
        seen, F.count("rejected").alias("_rejected"), F.sum(F.size(ACTIVITY_LIST)).alias("_rows"), *marks)
     .write.parquet(staged))
    found = seen.get
    try:
        missing = [f for f in ACTIVITY_FIELDS if found["_rows"] and found["_rows"] > 0 and not found[f]]
        if missing:
            raise ValueError(f"missing columns: {missing}")
        pages = spark.read.parquet(staged)
        if found["_rejected"]:
            bad = pages.filter("rejected IS NOT NULL").select(PAGE_FILE, F.col("rejected").alias("reason"))
            bad.write.mode("append").parquet(f"{out_base}_rejected")
        chain = _activity_chain(pages)
        chain_days(pages, chain).write.mode("append").parquet(f"{out_base}_days")
        rows = _activity_rows(chain)

        def by_day(df: DataFrame, path: str) -> None:
            (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("load_day").parquet(path))

        return {"complete": write_if_any(rows.filter("complete"), out_base, by_day),
                "incomplete": write_if_any(rows.filter("NOT complete"), f"{out_base}_incomplete", by_day)}
    finally:
        discard(spark, staged)


def land_all(spark: SparkSession, landed: str, out: str, run_ts: dt.datetime,
             endpoints: tuple[str, ...] = ("reports", "datasets", "groups", "dataflows", "dashboards"),
             schemas: dict[str, T.StructType] | None = None) -> dict[str, str]:
    """Every endpoint, then the details of active datasets.

    Output names follow ``Get<Endpoint>``.  ``schemas`` gives page schemas by
    endpoint (``datasources`` for the details); fields of one not given are text.
    The result has a status per endpoint: ``written``, ``empty``, ``partial: <bad pages>``
    (rows were landed, or pages without rows, but not every page was good) or ``failed:
    <reason>`` (nothing landed, or no good page).  A failed endpoint is skipped and the
    others are landed; without landed groups and datasets the details cannot be chosen,
    which is an error once everything else is landed.
    """
    schemas = schemas or {}
    status = {}

    def land(name: str, folder: str, **options) -> None:
        try:
            status[name] = land_pages(spark, f"{landed}/{folder}", f"{out}/Get{folder.capitalize()}", run_ts,
                                      schemas.get(name), **options).status
        except (ValueError, AnalysisException) as failure:
            status[name] = f"failed: {str(failure).splitlines()[0]}"

    for ep in endpoints:
        land(ep, ep)
    if {"groups", "datasets"} <= set(endpoints):
        lost = [ep for ep in ("groups", "datasets") if not status[ep].startswith(("written", "partial"))]
        if lost:
            raise ValueError(f"no details of active datasets without {' and '.join(lost)}: {status}")
        active = active_datasets(spark.read.parquet(f"{out}/GetGroups"), spark.read.parquet(f"{out}/GetDatasets"))
        land("datasources", "datasources", flatten=False, key="dataset_id", only=active.select("id"))
    return status


__all__ = ["Landed", "land_pages", "land_endpoint", "active_datasets", "land_details", "activity_pages", "activity_rows",
           "chain_days", "audit_days", "land_activity", "land_all", "rows_of", "tidy", "write_parquet"]
