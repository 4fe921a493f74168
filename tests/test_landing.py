import datetime as dt
import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from martkit.plans import landing
from martkit.sources import (
    day_windows, details_for, pages_until_error, read_envelope, union_pages, write_by_load_date,
    write_if_any,
)

RUN = dt.datetime(2024, 1, 31, 6, 30)


def put(path, doc):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump(doc, f)


def test_read_envelope_missing_keys_are_null(spark, tmp_dir):
    put(f"{tmp_dir}/p/1.json", {"value": [{"id": "a", "n": 1}, {"id": "b"}], "continuationUri": "next"})
    put(f"{tmp_dir}/p/2.json", {"value": [{"id": "c", "n": 3}]})
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType())])
    extra = T.StructType([T.StructField("continuationUri", T.StringType())])
    out = read_envelope(spark, f"{tmp_dir}/p", "value", schema, extra)
    assert rows(out, "id", "n", "continuationUri") == [("a", 1, "next"), ("b", None, "next"), ("c", 3, None)]


def test_read_envelope_reports_bad_pages(spark, tmp_dir):
    import pytest
    put(f"{tmp_dir}/p/1.json", {"value": [{"id": "a"}], "next": "n"})
    put(f"{tmp_dir}/p/2.json", {"error": 1})
    cut_page(f"{tmp_dir}/p/3.json")
    schema, extra = T.StructType.fromDDL("id string"), T.StructType.fromDDL("next string")
    with pytest.raises(Exception, match="no 'value' list|not JSON"):
        read_envelope(spark, f"{tmp_dir}/p", "value", schema, extra).collect()
    out = read_envelope(spark, f"{tmp_dir}/p", "value", schema, extra, keep_rejected=True).collect()
    assert sorted((os.path.basename(r.page_file), r.rejected, r.id, r.next) for r in out) == [
        ("1.json", None, "a", "n"), ("2.json", "no 'value' list", None, None), ("3.json", "not JSON", None, None)]


def test_pages_until_error(spark):
    chains = {
        "whole": ([(1, 200, "n"), (2, 200, "n"), (3, 200, None)], [1, 2, 3], True),
        "error": ([(1, 200, "n"), (2, 200, "n"), (3, 500, "n"), (4, 200, None)], [1, 2], False),
        "null": ([(1, 200, "n"), (2, None, "n"), (3, 200, None)], [1], False),
        "gap": ([(1, 200, "n"), (3, 200, None)], [1], False),
        "open": ([(1, 200, "n"), (2, 200, "n")], [1, 2], False),
        "after": ([(1, 200, "n"), (2, 200, None), (3, 200, "n")], [1, 2], True),
        "late": ([(2, 200, "n"), (3, 200, None)], [], None),
        "first": ([(1, 500, None), (2, 200, None)], [], None),
        None: ([(1, 200, None)], [1], True),
    }
    df = spark.createDataFrame([(k, *page) for k, (pages, _, _) in chains.items() for page in pages],
                               "day string, page int, status int, link string")
    out = pages_until_error(df, ["day"], "page", F.col("status") == 200, F.col("link").isNotNull()).collect()
    for k, (_, kept, complete) in chains.items():
        mine = [r for r in out if r.day == k]
        assert sorted(r.page for r in mine) == kept and {r.complete for r in mine} <= {complete}, k


def test_day_windows(spark):
    # Run at 2024-01-31, 30 days -> 2024-01-01 ... 2024-01-30, all of them.
    w = day_windows(spark, RUN, 30).collect()
    days = sorted(r.window_day for r in w)
    assert len(days) == 30 and days[0] == dt.date(2024, 1, 1) and days[-1] == dt.date(2024, 1, 30)
    closed = {r.window_day: r for r in day_windows(spark, RUN, 2, closed_second=True).collect()}
    r = closed[dt.date(2024, 1, 30)]
    assert (r.window_end, r.load_date) == (dt.datetime(2024, 1, 30, 23, 59, 59), "20240130")


def test_write_by_load_date_replaces_only_that_day(spark, tmp_dir):
    base = f"{tmp_dir}/act"
    write_by_load_date(spark.createDataFrame([(1,)], "v int"), base, "20240101")
    write_by_load_date(spark.createDataFrame([(2,)], "v int"), base, dt.date(2024, 1, 2))
    write_by_load_date(spark.createDataFrame([(3,), (4,)], "v int"), base, "20240101")
    got = rows(spark.read.parquet(base), "load_date", "v")
    assert got == [(20240101, 3), (20240101, 4), (20240102, 2)]


def test_write_if_any(spark, tmp_dir):
    assert write_if_any(spark.range(0), f"{tmp_dir}/empty") is False
    assert not os.path.exists(f"{tmp_dir}/empty")
    assert write_if_any(spark.range(3), f"{tmp_dir}/three") is True
    assert spark.read.parquet(f"{tmp_dir}/three").count() == 3


def test_details_union(spark):
    det = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    keys = spark.createDataFrame([(1,), (3,)], "key long")
    out = details_for(det, keys, "k", "key", stamp="dataset_id")
    assert rows(out, "k", "dataset_id") == [(1, 1), (3, 3)]
    u = union_pages([spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([(2,)], "a int")])
    assert rows(u, "a", "b") == [(1, "x"), (2, None)]


def test_land_all(spark, tmp_dir):
    landed, out = f"{tmp_dir}/landed", f"{tmp_dir}/out"
    put(f"{landed}/reports/1.json", {"value": [{"id": "r1", "name": "A", "web.url": "u", "owner": {"name": "x"}}]})
    put(f"{landed}/groups/1.json", {"value": [{"id": "w1", "state": "Active", "type": "Workspace"},
                                              {"id": "w2", "state": "Deleted", "type": "Workspace"}]})
    put(f"{landed}/datasets/1.json", {"value": [{"id": "d1", "workspaceId": "w1"}, {"id": "d2", "workspaceId": "w2"}]})
    put(f"{landed}/dataflows/1.json", {"value": []})
    put(f"{landed}/dashboards/1.json", {"value": [{"id": "b1"}]})
    put(f"{landed}/datasources/dataset_id=d1/1.json", {"value": [{"datasourceType": "Sql",
                                                                  "connectionDetails": {"server": "s1"}}]})
    put(f"{landed}/datasources/dataset_id=d2/1.json", {"value": [{"datasourceType": "File"}]})
    written = landing.land_all(spark, landed, out, RUN)
    assert written == {"reports": "written", "datasets": "written", "groups": "written", "dataflows": "empty",
                       "dashboards": "written", "datasources": "written"}
    rep = spark.read.parquet(f"{out}/GetReports").first()
    assert sorted(rep.asDict()) == ["ETLImportDate", "id", "name", "owner_name", "web_url"]
    assert rep.ETLImportDate == "2024-01-31"
    ds = spark.read.parquet(f"{out}/GetDatasources").collect()
    assert len(ds) == 1 and ds[0].dataset_id == "d1" and ds[0].connectionDetails.server == "s1"


def test_land_all_skips_failed_endpoints_and_keeps_every_group(spark, tmp_dir):
    import pytest
    landed, out = f"{tmp_dir}/landed", f"{tmp_dir}/out"
    put(f"{landed}/reports/1.json", {"error": "forbidden"})                        # no row list
    put(f"{landed}/groups/1.json", {"value": [{"id": f"w{i}", "state": "Active", "type": "Workspace"}
                                              for i in range(8000)]})
    put(f"{landed}/datasets/1.json", {"value": [{"id": "d1", "workspaceId": "w7999"}]})
    put(f"{landed}/datasources/dataset_id=d1/1.json", {"value": [{"datasourceType": "Sql"}]})
    status = landing.land_all(spark, landed, out, RUN)                             # dataflows, dashboards: absent
    assert [status[e] for e in ("groups", "datasets", "datasources")] == ["written"] * 3
    assert all(status[e].startswith("failed: ") for e in ("reports", "dataflows", "dashboards"))
    assert spark.read.parquet(f"{out}/GetGroups").count() == 8000
    assert spark.read.parquet(f"{out}/GetDatasources").count() == 1
    put(f"{tmp_dir}/none/datasets/1.json", {"value": [{"id": "d1", "workspaceId": "w1"}]})
    with pytest.raises(ValueError, match="without groups"):
        landing.land_all(spark, f"{tmp_dir}/none", f"{tmp_dir}/out2", RUN)
    assert spark.read.parquet(f"{tmp_dir}/out2/GetDatasets").count() == 1          # landed before the error


def put_day(landed, day, statuses, tag, open_end=False):
    ev = {f: None for f in landing.ACTIVITY_FIELDS}
    for i, st in enumerate(statuses, start=1):
        ents = [dict(ev, Id=f"{tag}-{i}", RecordType=20, IsSuccess=True, Extra="dropped")] if st == 200 else []
        link = "next" if i < len(statuses) or open_end else None
        put(f"{landed}/load_day={day}/p{i}.json",
            {"page_no": i, "status_code": st, "activityEventEntities": ents, "continuationUri": link})


def test_land_activity(spark, tmp_dir):
    first, again, out = f"{tmp_dir}/first", f"{tmp_dir}/again", f"{tmp_dir}/out"
    put_day(first, "20240130", [200, 200], "a")
    put_day(first, "20231201", [200], "old")                                       # long before the run: landed too
    assert landing.land_activity(spark, first, out) == {"complete": True, "incomplete": False}
    put_day(again, "20240130", [200, 500, 200], "b")                               # a failed re-pull
    put_day(again, "20240129", [200], "c", open_end=True)                          # a cut chain
    put_day(again, "20240128", [200, 200], "d")
    assert landing.land_activity(spark, again, out) == {"complete": True, "incomplete": True}
    got = spark.read.parquet(out)
    assert sorted(r.Id for r in got.collect()) == ["a-1", "a-2", "d-1", "d-2", "old-1"]
    assert sorted(r.Id for r in spark.read.parquet(f"{out}_incomplete").collect()) == ["b-1", "c-1"]
    r = got.filter("Id = 'a-1'").first()
    assert (r.startDateTime, r.endDateTime, r.complete) == ("'2024-01-30T00:00:00Z'", "'2024-01-30T23:59:59Z'", True)
    assert "Extra" not in got.columns


def test_endpoint_empty_and_strict_fields(spark, tmp_dir):
    import pytest
    put(f"{tmp_dir}/l/empty/1.json", {"value": []})
    assert landing.land_endpoint(spark, f"{tmp_dir}/l/empty", f"{tmp_dir}/o/a", RUN) is False
    assert landing.land_endpoint(spark, f"{tmp_dir}/l/empty", f"{tmp_dir}/o/b", RUN, skip_empty=False) is True
    assert spark.read.parquet(f"{tmp_dir}/o/b").count() == 0
    # A kept field missing from every landed row fails the job.
    put(f"{tmp_dir}/act/load_day=20240130/p1.json",
        {"page_no": 1, "status_code": 200, "activityEventEntities": [{"Id": "a"}]})
    with pytest.raises(ValueError, match="missing columns"):
        landing.land_activity(spark, f"{tmp_dir}/act", f"{tmp_dir}/o/c")


def test_assign_day_window_bounds(spark):
    # Half-open windows keep 23:59:59.5; the original 23:59:59 end drops it.
    from martkit.sources import assign_day_window, window_texts
    ev = spark.sql("select * from values (1, timestamp_ntz'2024-01-30 23:59:59.5'), "
                   "(2, timestamp_ntz'2024-01-30 00:00:00'), (3, timestamp_ntz'2024-01-31 00:00:00') as t(id, ts)")
    half = assign_day_window(ev, "ts", day_windows(spark, RUN, 2))
    closed = assign_day_window(ev, "ts", day_windows(spark, RUN, 2, closed_second=True), closed_second=True)
    assert sorted(r.id for r in half.collect()) == [1, 2]
    assert sorted(r.id for r in closed.collect()) == [2]
    r = window_texts(half.filter("id = 2"), quoted=True).first()
    assert (r.start_datetime, r.end_datetime, r.load_date) == ("'2024-01-30T00:00:00Z'", "'2024-01-31T00:00:00Z'",
                                                               "20240130")


def test_from_json_col_and_stamp(spark):
    from martkit.operators import stamp_load_date
    from martkit.sources import from_json_col
    df = spark.createDataFrame([('{"k": 5, "x": "a"}',), ('{"x": "b"}',), ("not json",)], "props string")
    got = [r.k for r in df.select(from_json_col("props", "k int").getField("k").alias("k")).collect()]
    assert got == [5, None, None]
    assert stamp_load_date(df, RUN).first().ETLImportDate == "2024-01-31"


def cut_page(path, text='{"value": [{"id": "lost"}'):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_bad_pages_are_reported_and_listed(spark, tmp_dir):
    landed, out = f"{tmp_dir}/landed", f"{tmp_dir}/out"
    put(f"{landed}/groups/1.json", {"value": [{"id": "w1", "state": "Active", "type": "Workspace"}]})
    cut_page(f"{landed}/groups/2.json")
    cut_page(f"{landed}/groups/3.json", "")
    put(f"{landed}/groups/4.json", {"error": "forbidden"})
    for schema in (None, T.StructType.fromDDL("value array<struct<id: string, state: string, type: string>>")):
        done = landing.land_pages(spark, f"{landed}/groups", f"{out}/GetGroups", RUN, schema)
        assert (done.rows, done.pages, done.rejected_pages) == (1, 4, 3) and done.status.startswith("partial: 3 of 4 pages rejected")
        assert [os.path.basename(x.split(" ")[0]) for x in done.rejected] == ["2.json", "3.json", "4.json"]
        why = {os.path.basename(r.page_file): r.reason for r in spark.read.parquet(f"{out}/GetGroups_rejected").collect()}
        assert why == {"2.json": "not JSON", "3.json": "empty file", "4.json": "no 'value' list"}
        assert [r.id for r in spark.read.parquet(f"{out}/GetGroups").collect()] == ["w1"]
    put(f"{landed}/datasets/1.json", {"value": [{"id": "d1", "workspaceId": "w1"}]})
    cut_page(f"{landed}/datasources/d1.json")
    cut_page(f"{landed}/datasources/d2.json")                                     # not an active dataset
    status = landing.land_all(spark, landed, out, RUN, endpoints=("groups", "datasets"))
    assert status["groups"].startswith("partial: ") and "2.json" in status["groups"]
    assert status["datasets"] == "written" and status["datasources"].startswith("failed: 1 of 1 pages rejected")


def test_a_failed_or_empty_run_keeps_what_was_landed(spark, tmp_dir):
    put(f"{tmp_dir}/l/a/1.json", {"value": [{"id": "a"}]})
    put(f"{tmp_dir}/l/b/1.json", {"value": []})
    assert landing.land_pages(spark, f"{tmp_dir}/l/a", f"{tmp_dir}/o", RUN).status == "written"
    assert landing.land_pages(spark, f"{tmp_dir}/l/b", f"{tmp_dir}/o", RUN).status == "empty"
    assert [r.id for r in spark.read.parquet(f"{tmp_dir}/o").collect()] == ["a"]
    assert sorted(os.listdir(tmp_dir)) == ["l", "o"]                              # nothing staged is left


def test_types_do_not_depend_on_the_day(spark, tmp_dir):
    put(f"{tmp_dir}/a/1.json", {"value": [{"id": 5, "size": 1, "owner": {"name": "x", "no": 1}, "tags": [1, 2], "none": None}]})
    put(f"{tmp_dir}/a/2.json", {"value": [{"id": "five", "size": 2.5, "owner": {"name": True}, "mixed": {"a": 1}}, {"mixed": "m"}]})
    put(f"{tmp_dir}/b/1.json", {"value": [{"id": "6", "size": "big", "owner": {"name": "y"}, "tags": "none"}]})
    for day in "ab":
        assert landing.land_pages(spark, f"{tmp_dir}/{day}", f"{tmp_dir}/o/{day}", RUN).status == "written"
    kinds = [{f.name: f.dataType.simpleString() for f in spark.read.parquet(f"{tmp_dir}/o/{day}").schema} for day in "ab"]
    assert set(kinds[0].values()) == set(kinds[1].values()) == {"string"}
    got = {r.id: r for r in spark.read.parquet(f"{tmp_dir}/o/a").collect()}
    assert (got["5"].owner_name, got["5"].owner_no, got["5"].tags, got["5"].none) == ("x", "1", "[1,2]", None)
    assert (got["five"].owner_name, got["five"].size, got["five"].mixed, got[None].mixed) == ("true", "2.5", '{"a":1}', "m")
    schema = T.StructType.fromDDL("value array<struct<id: int, size: double, owner: struct<name: string>>>")
    done = landing.land_pages(spark, f"{tmp_dir}/a", f"{tmp_dir}/o/typed", RUN, schema)
    assert done.status == "partial: 1 values did not fit their type"
    assert sorted((r.id or 0, r.size or 0.0) for r in spark.read.parquet(f"{tmp_dir}/o/typed").collect()) == [
        (0, 0.0), (0, 2.5), (5, 1.0)]


def test_details_by_file_name_equal_details_by_folder(spark, tmp_dir):
    for i in ("007", "b-1", "gone"):
        rows_ = {"value": [{"datasourceType": "Sql", "connectionDetails": {"server": i}}]}
        put(f"{tmp_dir}/folders/dataset_id={i}/1.json", rows_)
        put(f"{tmp_dir}/files/{i}.json", rows_)
    active = spark.createDataFrame([("007",), ("b-1",)], "id string")
    for kind in ("folders", "files"):
        assert landing.land_details(spark, f"{tmp_dir}/{kind}", active, f"{tmp_dir}/{kind}_out", RUN)
    a, b = (spark.read.parquet(f"{tmp_dir}/{kind}_out") for kind in ("folders", "files"))
    assert rows(a) == rows(b) and sorted(r.dataset_id for r in a.collect()) == ["007", "b-1"]
    assert {r.connectionDetails.server for r in a.collect()} == {"007", "b-1"}


def test_activity_bad_pages_and_day_audit(spark, tmp_dir):
    landed, out = f"{tmp_dir}/landed", f"{tmp_dir}/out"
    put_day(landed, "20240130", [200, 200], "a")
    put_day(landed, "20240129", [200, 200, 200], "b")
    cut_page(f"{landed}/load_day=20240129/p2.json")                               # cut off in the middle of the chain
    cut_page(f"{landed}/load_day=20240128/p1.json")                               # nothing else of that day
    assert landing.land_activity(spark, landed, out) == {"complete": True, "incomplete": True}
    bad = spark.read.parquet(f"{out}_rejected").collect()
    assert sorted(r.page_file.rpartition("/landed/")[2] for r in bad) == ["load_day=20240128/p1.json", "load_day=20240129/p2.json"]
    assert [r.Id for r in spark.read.parquet(f"{out}_incomplete").collect()] == ["b-1"]
    audit = landing.audit_days(day_windows(spark, RUN, 5), spark.read.parquet(f"{out}_days"))
    assert rows(audit, "load_day", "status") == [
        ("20240126", "absent"), ("20240127", "absent"), ("20240128", "incomplete"), ("20240129", "incomplete"),
        ("20240130", "complete")]
    again = f"{tmp_dir}/again"
    put_day(again, "20240129", [200], "c")
    put_day(again, "20240130", [500], "d")                                        # a worse pull changes nothing
    landing.land_activity(spark, again, out)
    audit = landing.audit_days(day_windows(spark, RUN, 2), spark.read.parquet(f"{out}_days"))
    assert rows(audit, "load_day", "status") == [("20240129", "complete"), ("20240130", "complete")]
    assert not [f for f in os.listdir(tmp_dir) if "staged" in f]
