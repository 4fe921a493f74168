import datetime as dt

from conftest import SF_SMALL
from martkit.functions.sql import register_sql_functions
from martkit.plans import catalog, derived
from martkit.plans.queries import Tables
from martkit.plans.views import control_view, ledger_view


def test_sql_functions_are_inlined(spark):
    register_sql_functions(spark, dt.datetime(2024, 1, 31, 6, 0))
    df = spark.sql("select div0(1, 0) a, div0(1, null) b, div0(3, 2) c, run_ts() t")
    r = df.first()
    assert (r.a, r.b, r.c, r.t) == (0.0, None, 1.5, dt.datetime(2024, 1, 31, 6, 0))
    plan = spark.sql("select div0(id, id - 1) from range(3)")._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "CASE WHEN" in plan


def test_views_for_sql_users(spark):
    t = Tables(spark, SF_SMALL)
    inputs = derived.ledger_inputs({n: getattr(t, n) for n in ["orders", "lineitem", "customer", "nation", "region"]})
    ledger_view(inputs, dt.datetime(1999, 6, 30))
    n = spark.sql("select count(*) from fact_account_balances where is_actual_amt_flag = 1").first()[0]
    assert n > 0
    control_view(catalog.catalog_tables(t))
    r = spark.sql("select count(*), sum(IsTableConsideredActive) from source_control_statements").first()
    assert r[0] > 0 and 0 < r[1] <= r[0]


def test_ledger_function_equals_the_plan_and_prunes_years(spark):
    from martkit.plans import ledger
    from martkit.plans.views import ledger_function
    from conftest import rows
    t = Tables(spark, SF_SMALL)
    inputs = derived.ledger_inputs({n: getattr(t, n) for n in ["orders", "lineitem", "customer", "nation", "region"]})
    ledger_function(inputs, "ledger_by_time")
    for ts in (dt.datetime(1996, 1, 1), dt.datetime(1999, 6, 30)):
        sql = spark.sql(f"SELECT * FROM ledger_by_time(run_ts => TIMESTAMP_NTZ '{ts}')")
        plan = ledger.ledger_fact(*[inputs[k] for k in ("account_balances", "account_master", "business_unit_master",
                                                        "company_constants", "dim_date", "codes", "profit_recognition")], ts)
        assert sql.columns == ledger.FACT_COLUMNS and sql.schema.simpleString() == plan.schema.simpleString()
        assert rows(sql) == rows(plan) and sql.count() > 0
    text = sql._jdf.queryExecution().optimizedPlan().toString()
    assert text.rindex("Filter") > text.rindex("Generate explode")             # the year bound is below the unpivot


def test_profit_function_of_single_amounts(spark):
    from martkit.plans.views import profit_function
    name = profit_function(spark, "measures_of")
    r = spark.sql(f"SELECT m.* FROM {name}(-200, 100, -50, 20, -60, 0) m").first()
    p = "profit_recognition_"
    assert (r[f"{p}projected_margin"], r[f"{p}projected_margin_percent"], r[f"{p}percent_complete"]) == (100.0, 0.5, 0.0)
    assert (r[f"{p}backlog"], r[f"{p}accrued_loss"], r[f"{p}earned_margin_percent"]) == (260.0, 0, 0.6)
    assert spark.sql(f"SELECT m.* FROM {name}(0, 100, 0, 0, 0, 0) m").first()[f"{p}accrued_loss"] == 1
