"""Run registered queries in Spark and their oracle SQL in DuckDB; compare
row counts, column names and types, and order-insensitive values.

    python tools/compare.py [sf_dir] [query ...]
"""
import hashlib
import sys
import time

sys.path.insert(0, "/root/repo")

import duckdb
import pandas as pd

from martkit.session import build_session
from martkit.plans.queries import REGISTRY
from martkit.plans.oracle import ORACLE

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float) and v != v:
        return "NaN"
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, float):
        return repr(v)
    return str(v)


def rows_of(tbl):
    cols = sorted(tbl.column_names)
    data = [tbl.column(c).to_pylist() for c in cols]
    return sorted(tuple(norm(v) for v in r) for r in zip(*data)), cols


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(REGISTRY)
    spark = build_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            sdf = REGISTRY[n](spark, sf)
            s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
            s = sdf.toArrow()
            t1 = time.time()
            o = con.sql(ORACLE[n]).to_arrow_table()
            o_types = {f.name: str(f.type) for f in o.schema}
        except Exception as e:
            print(f"{n:26s} ERROR {type(e).__name__}: {str(e)[:400]}", flush=True)
            bad += 1
            continue
        sr, sc = rows_of(s)
        orows, oc = rows_of(o)
        ok_cols = sc == oc
        ok_rows = len(sr) == len(orows)
        ok_vals = sr == orows
        status = "OK" if (ok_cols and ok_rows and ok_vals) else "MISMATCH"
        h = hashlib.sha1(repr(sr).encode()).hexdigest()[:8]
        print(f"{n:26s} {status:8s} rows spark={len(sr)} duck={len(orows)} spark={t1-t0:5.2f}s hash={h}", flush=True)
        tmap = {"int": "int32", "bigint": "int64", "double": "double", "string": "string", "date": "date32[day]",
                "timestamp_ntz": "timestamp[us]", "boolean": "bool"}
        tbad = [f"{k}:{s_types.get(k)}/{o_types.get(k)}" for k in sc if tmap.get(s_types.get(k)) != o_types.get(k)]
        if tbad:
            print(f"    TYPE DIFF {' '.join(tbad)}")
        if status != "OK":
            bad += 1
            if not ok_cols:
                print("   cols spark:", sc, "\n   cols duck: ", oc)
            else:
                sset, oset = set(sr), set(orows)
                only_s = [r for r in sr if r not in oset][:3]
                only_o = [r for r in orows if r not in sset][:3]
                print("   cols:", sc)
                print("   only spark:", only_s)
                print("   only duck: ", only_o)
    print(f"done: {len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main()
