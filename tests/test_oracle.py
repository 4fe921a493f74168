"""Every registered query against its DuckDB oracle on the sf0.001 tables."""
import duckdb
import pytest

from conftest import SF_SMALL
from martkit.plans.oracle import ORACLE
from martkit.plans.queries import REGISTRY

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def canon(tbl):
    cols = sorted(tbl.column_names)
    data = [tbl.column(c).to_pylist() for c in cols]
    return cols, sorted(tuple(repr(v) for v in r) for r in zip(*data))


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, duck, name):
    got = canon(REGISTRY[name](spark, SF_SMALL).toArrow())
    want = canon(duck.sql(ORACLE[name]).to_arrow_table())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
