"""Register the jobs' results as temporary views and table functions for SQL users."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from martkit.functions.sql import register_sql_functions
from martkit.operators.shape import as_view
from martkit.plans import control, ledger


def ledger_view(inputs: dict[str, DataFrame], run_ts: dt.datetime,
                name: str = "fact_account_balances") -> DataFrame:
    """The ledger fact as a view; ``inputs`` holds the seven input tables."""
    df = ledger.ledger_fact(inputs["account_balances"], inputs["account_master"], inputs["business_unit_master"],
                            inputs["company_constants"], inputs["dim_date"], inputs["codes"],
                            inputs["profit_recognition"], run_ts)
    return as_view(df, ledger.FACT_COLUMNS, name)


def control_view(catalog: dict[str, DataFrame], name: str = "source_control_statements") -> DataFrame:
    """The control-statement table as a view; ``catalog`` holds the twelve catalog tables."""
    return as_view(control.control_statements(**catalog), control.OUTPUT_COLUMNS, name)


def ledger_function(inputs: dict[str, DataFrame], name: str = "ledger_fact") -> str:
    """Register ``SELECT * FROM ledger_fact(run_ts => TIMESTAMP_NTZ '...')``: the ledger fact as of a run time.

    The function is SQL over a view of all years, so the analyzer inlines it: its year bound is pushed to the
    balances like that of the DataFrame plan, and callers can filter, join and project it. Returns the name.
    """
    rows = ledger.ledger_rows(inputs["account_balances"], inputs["account_master"], inputs["business_unit_master"],
                              inputs["company_constants"], inputs["dim_date"], inputs["codes"],
                              inputs["profit_recognition"], None)
    rows.createOrReplaceTempView(f"{name}_rows")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "fiscal_year")
    rows.sparkSession.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(run_ts TIMESTAMP_NTZ) RETURNS TABLE ({columns})
        RETURN SELECT {", ".join(ledger.FACT_COLUMNS)} FROM {name}_rows
               WHERE CAST(fiscal_year AS INT) <= year({name}.run_ts)""")
    return name


def profit_function(spark: SparkSession, name: str = "profit_measures") -> str:
    """Register the profit measures as a table function of the six amounts, for ``LATERAL`` joins.

    Each measure names the ones before it (lateral column aliases). Returns the name.
    """
    p = "profit_recognition_"
    measures = [
        ("adjusted_projected_final_revenue", "abs(planned_revenue)"),
        ("adjusted_projected_final_cost", "planned_cost"),
        ("projected_margin", f"{p}adjusted_projected_final_revenue - {p}adjusted_projected_final_cost"),
        ("projected_margin_percent", f"div0({p}projected_margin, {p}adjusted_projected_final_revenue)"),
        ("earned_revenue", "abs(earned_so_far)"),
        ("earned_cost", "spent_on_earned"),
        ("earned_margin", f"{p}earned_revenue - {p}earned_cost"),
        ("earned_margin_percent", f"div0({p}earned_margin, {p}earned_revenue)"),
        ("actual_cost", "booked_cost"),
        ("actual_revenue", "booked_revenue"),
        ("backlog", f"{p}adjusted_projected_final_revenue - {p}actual_revenue"),
        ("percent_complete", f"div0({p}actual_cost, {p}adjusted_projected_final_cost)"),
        ("cost_of_revenue", f"{p}percent_complete * {p}adjusted_projected_final_revenue"),
        ("remaining_to_complete_revenue", f"{p}adjusted_projected_final_revenue - {p}actual_revenue"),
        ("remaining_to_complete_cost", f"{p}adjusted_projected_final_cost - {p}actual_cost"),
        ("remaining_to_complete_margin", f"{p}remaining_to_complete_revenue - {p}remaining_to_complete_cost"),
        ("accrued_loss", f"CASE WHEN {p}projected_margin < 0 THEN 1 ELSE 0 END"),
    ]
    register_sql_functions(spark)
    amounts = ["planned_revenue", "planned_cost", "earned_so_far", "spent_on_earned", "booked_revenue", "booked_cost"]
    kinds = ", ".join(f"{p}{m} {'INT' if m == 'accrued_loss' else 'DOUBLE'}" for m, _ in measures)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}({", ".join(f"{a} DOUBLE" for a in amounts)}) RETURNS TABLE ({kinds})
        RETURN SELECT {", ".join(f"{sql} AS {p}{m}" for m, sql in measures)}""")
    return name
