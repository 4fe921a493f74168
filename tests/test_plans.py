"""Plan checks: no cartesian products or Python UDFs, pushdown reaches the
scan, the early year bound sits below the generator, top-1 is an aggregate."""
import pytest

from conftest import SF_SMALL
from martkit.plans.queries import REGISTRY


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_cartesian_or_python(spark, name):
    p = plan(REGISTRY[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin"):
        assert bad not in p, bad


def test_filter_and_projection_reach_the_scan(spark):
    p = plan(REGISTRY["active_semi"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(c_mktsegment), IsNotNull(c_acctbal), EqualTo(c_mktsegment,BUILDING)" in p
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double,c_mktsegment:string>" in p


def test_year_bound_below_generate(spark):
    p = plan(REGISTRY["year_bound_early"](spark, SF_SMALL))
    gen = p.index("Generate")
    # The year filter is applied to the wide rows, i.e. below (after in the text) the generator.
    assert "<= 1998" in p[gen:]


def test_best_row_is_an_aggregate_not_a_window(spark):
    p = plan(REGISTRY["best_row"](spark, SF_SMALL))
    # Partial + final aggregation (min of a struct plans as SortAggregate): a
    # hot key is combined map-side instead of being buffered by a window.
    assert "Window" not in p
    assert "partial_min(struct" in p


def jobs_started(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().nextJobId()


#: These write tables on their way: the rounds of pointer doubling, and a merge into files.
WRITERS = {"link_chains", "partition_merge"}


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - WRITERS))
def test_building_a_query_reads_footers_only(spark, name):
    # spark.read.parquet starts one job per table to read a footer; nothing else may run.
    tables = 8
    before = jobs_started(spark)
    REGISTRY[name](spark, SF_SMALL)
    assert jobs_started(spark) - before <= tables
    from martkit.plans.queries import Tables, load
    before = jobs_started(spark)
    load(spark, SF_SMALL, "orders")
    assert jobs_started(spark) - before <= 1


@pytest.fixture()
def no_broadcast(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, -1)
    yield
    for name in names:
        spark.conf.unset(name)


def test_ledger_fact_reads_each_fact_once(spark):
    p = plan(REGISTRY["ledger_fact"](spark, SF_SMALL))
    assert p.count("lineitem.parquet") == 1
    assert p.count("orders.parquet") <= 4          # balances, and the calendar's span in two lookups


def test_control_table_has_no_arrays_or_windows_and_two_steps_of_texts(spark, no_broadcast):
    p = plan(REGISTRY["control_table"](spark, SF_SMALL))
    assert "Window" not in p and "collect_list" not in p and "array_contains" not in p
    assert p.count("Exchange hashpartitioning(g_") == 2                          # by chunk, and the chunks of a table
