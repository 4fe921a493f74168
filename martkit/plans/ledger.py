"""Ledger fact: monthly balances to long rows with flags and profit measures.

Input tables (column names as listed in FIXTURES.md section 1):
``account_balances`` (12 monthly amounts in hundredths), ``account_master``,
``business_unit_master``, ``company_constants``, ``dim_date``,
``user_defined_code_values`` and ``profit_recognition``.

Plan shape (what Spark runs):

1. The year bound is applied to the *wide* rows, before the unpivot; for
   four-digit years it equals the final ``left(year_month_id, 4) <= run
   year`` test, and a filter on generator output is not pushed below a
   ``Generate`` by Catalyst.
2. Dimension lookups and every month-independent flag run on the wide rows
   (12x fewer rows than after the unpivot).
3. The unpivot is a ``Generate`` (no shuffle).
4. The profit rows match on (business unit, year, month), a grain coarser
   than their key, so rows may multiply (kept on purpose).  Their measures
   depend on the profit row alone and are computed there.  They are joined to
   the wide rows on (unit, year), and a joined row is unpivoted to the months of
   its profit row only; one more row per unit and year stands for the months
   without any.  So the wide rows are shuffled, not the 12 times as many long
   ones; no row carries more than one profit row: a busy unit makes no row large,
   Spark broadcasts the profit rows if they are few, and otherwise AQE splits a
   hot unit.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.functions.numbers import div0, hundredths, period_id
from martkit.functions.text import concat_strict, lpad_number
from martkit.operators.joins import left_lookup, require_unique
from martkit.operators.shape import unpivot_columns

# ---------------------------------------------------------------------------
# Business codes and output columns of the ledger view.  They
# must equal the original's for equal results.
PLAN_UNIT_TYPES = ["P1", "P2"]
COST_BUSINESS_UNITS = ["90090", "90091", "90092", "90093", "90094"]
COST_ACCOUNT_RANGE = ("6000", "6099")
EXCLUDED_SUBSIDIARY_PATTERN = "99%"
ALWAYS_INCLUDED_SUBSIDIARY = "99999955"
REVENUE_SUBSIDIARY_PATTERN = "8500%"
REVENUE_ACCOUNT_PATTERN = "5%"
OTHER_ACCOUNT_PATTERN = "4%"
RECORD_TYPE_CODES = ("H50", "TY")   # (product_code, user_defined_codes) of record-type names
LEDGER_TYPE_CODES = ("09", "LT")    # (product_code, user_defined_codes) of ledger-type names
CHANGE_UNIT_DETAIL_LEVEL = 7
MONTH_COLUMNS = [f"amount_net_posting_{m:02d}" for m in range(1, 13)]
FACT_COLUMNS = [
    "year_month_id", "account_id", "ledger_type_code", "ledger_type_desc", "subledger_g_l",
    "subledger_type", "company_code", "business_unit_code", "business_unit_type", "bu_status",
    "project_manager_code", "object_account_code", "account_subsidiary",
    "is_included_account_subsidiary", "account_level_of_detail", "category", "amount_net_posting",
    "amount_beginning_balance_pye_forward", "amount_original_beginning_budget", "is_revised_amount",
    "is_revised_unit", "is_change_amount", "is_change_unit", "is_orig_amt_flag", "is_orig_unit_flag",
    "is_bill_to_date_amt_flag", "is_prev_yr_cost_to_date_amt_flag",
    "latest_closed_period_year_month_id", "is_latest_closed_period_flag", "is_cost_to_date_amt_flag",
    "is_actual_qty_flag", "is_actual_amt_flag",
    "profit_recognition_adjusted_projected_final_revenue",
    "profit_recognition_adjusted_projected_final_cost", "profit_recognition_projected_margin",
    "profit_recognition_projected_margin_percent", "profit_recognition_earned_revenue",
    "profit_recognition_earned_cost", "profit_recognition_earned_margin",
    "profit_recognition_earned_margin_percent", "profit_recognition_backlog",
    "profit_recognition_actual_cost", "profit_recognition_percent_complete",
    "profit_recognition_cost_of_revenue", "profit_recognition_actual_revenue",
    "profit_recognition_remaining_to_complete_revenue",
    "profit_recognition_remaining_to_complete_cost",
    "profit_recognition_remaining_to_complete_margin", "profit_recognition_accrued_loss",
]
PROFIT_AMOUNTS = [
    "actual_revenue_to_date", "actual_cost_to_date", "projected_final_revenue", "projected_final_cost",
    "projected_final_revenue_adjusted", "projected_final_cost_adjusted",
    "earned_job_to_date_revenue", "earned_job_to_date_cost",
]
# ---------------------------------------------------------------------------


# --- scalar business rules (Column -> Column) --------------------------------

def closed_flag(year_month_id, closed_period) -> Column:
    """1 unless the period is after the latest closed period.  An unknown
    closed period gives 1 (the comparison is NULL and falls to ELSE)."""
    return F.when(F.col(year_month_id) > F.col(closed_period).cast("bigint"), 0).otherwise(1)


def included_subsidiary(sub: Column) -> Column:
    """0 for subsidiaries starting ``99`` except ``99999955``; NULL counts as included."""
    return F.when(~sub.like(EXCLUDED_SUBSIDIARY_PATTERN) | (sub == ALWAYS_INCLUDED_SUBSIDIARY)
                  | sub.isNull(), 1).otherwise(0)


def account_category(sub: Column, account: Column) -> Column:
    """Revenue / Other / Cost; the first matching rule wins."""
    return (F.when(sub.like(REVENUE_SUBSIDIARY_PATTERN) | (sub == ALWAYS_INCLUDED_SUBSIDIARY)
                   | account.like(REVENUE_ACCOUNT_PATTERN), "Revenue")
            .when(account.like(OTHER_ACCOUNT_PATTERN), "Other")
            .otherwise("Cost"))


def plan_ledger_flag(unit_type: Column, ledger: Column, plan_ledger: str, other_ledger: str) -> Column:
    """1 when a plan unit (P1/P2) posts to ``plan_ledger`` or another unit
    posts to ``other_ledger``.  A NULL unit type gives 0."""
    plan = unit_type.isin(*PLAN_UNIT_TYPES)
    return F.when(plan & (ledger == plan_ledger), 1).when(~plan & (ledger == other_ledger), 1).otherwise(0)


def cost_to_date_flag(ledger: Column, account: Column, unit: Column) -> Column:
    """Actual-amount ledger on a cost account range (text comparison) or a cost unit."""
    lo, hi = COST_ACCOUNT_RANGE
    return F.when((ledger == "AA") & account.between(lo, hi), 1) \
            .when((ledger == "AA") & unit.isin(*COST_BUSINESS_UNITS), 1).otherwise(0)


def ledger_flags(ledger: Column, unit_type: Column, account: Column, unit: Column,
                 detail_level: Column) -> dict[str, Column]:
    """Every month-independent 0/1 flag of a balance row."""
    return {
        "is_revised_amount": plan_ledger_flag(unit_type, ledger, "BA", "JA"),
        "is_revised_unit": plan_ledger_flag(unit_type, ledger, "BU", "JU"),
        "is_change_amount": F.when(ledger == "QA", 1).otherwise(0),
        "is_change_unit": F.when((ledger == "QU") & (detail_level == CHANGE_UNIT_DETAIL_LEVEL), 1).otherwise(0),
        "is_orig_amt_flag": plan_ledger_flag(unit_type, ledger, "BA", "JA"),
        "is_orig_unit_flag": plan_ledger_flag(unit_type, ledger, "BU", "JU"),
        "is_bill_to_date_amt_flag": F.when((ledger == "AA") & account.like(REVENUE_ACCOUNT_PATTERN), 1).otherwise(0),
        "is_prev_yr_cost_to_date_amt_flag": cost_to_date_flag(ledger, account, unit),
        "is_cost_to_date_amt_flag": cost_to_date_flag(ledger, account, unit),
        "is_actual_qty_flag": F.when(ledger == "AU", 1).otherwise(0),
        "is_actual_amt_flag": F.when(ledger == "AA", 1).otherwise(0),
    }


def add_profit_measures(df: DataFrame, adj_revenue: str, adj_cost: str, earned_revenue: str,
                        earned_cost: str, actual_revenue: str, actual_cost: str,
                        prefix: str = "profit_recognition_") -> DataFrame:
    """Projected / earned / remaining measures; each builds on the previous
    ones (alias reuse), computed in order."""
    p = prefix
    c = F.col
    return df.withColumns({
        f"{p}adjusted_projected_final_revenue": F.abs(c(adj_revenue)),
        f"{p}adjusted_projected_final_cost": c(adj_cost),
    }).withColumns({
        f"{p}projected_margin": c(f"{p}adjusted_projected_final_revenue") - c(f"{p}adjusted_projected_final_cost"),
        f"{p}earned_revenue": F.abs(c(earned_revenue)),
        f"{p}earned_cost": c(earned_cost),
        f"{p}actual_cost": c(actual_cost),
        f"{p}actual_revenue": c(actual_revenue),
        f"{p}percent_complete": div0(c(actual_cost), c(adj_cost)),
    }).withColumns({
        f"{p}projected_margin_percent": div0(c(f"{p}projected_margin"), c(f"{p}adjusted_projected_final_revenue")),
        f"{p}earned_margin": c(f"{p}earned_revenue") - c(f"{p}earned_cost"),
        f"{p}backlog": c(f"{p}adjusted_projected_final_revenue") - c(actual_revenue),
        f"{p}cost_of_revenue": c(f"{p}percent_complete") * c(f"{p}adjusted_projected_final_revenue"),
        f"{p}remaining_to_complete_revenue": c(f"{p}adjusted_projected_final_revenue") - c(f"{p}actual_revenue"),
        f"{p}remaining_to_complete_cost": c(f"{p}adjusted_projected_final_cost") - c(f"{p}actual_cost"),
        f"{p}accrued_loss": F.when(c(f"{p}projected_margin") < 0, 1).otherwise(0),
    }).withColumns({
        f"{p}earned_margin_percent": div0(c(f"{p}earned_margin"), c(f"{p}earned_revenue")),
        f"{p}remaining_to_complete_margin": c(f"{p}remaining_to_complete_revenue") - c(f"{p}remaining_to_complete_cost"),
    })


# --- relations ----------------------------------------------------------------

def closed_periods(company_constants: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Latest closed period per company as ``YYYYMM`` text.

    Current period 1 closes month 12 of the previous fiscal year; otherwise
    period - 1 of the fiscal year.  An unknown fiscal year gives NULL.
    """
    cc = left_lookup(company_constants, dim_date,
                     [("date_fiscal_year_begins", "julian_date")], {"fiscal_year_begin_date": "calendar_date"})
    fy = F.year("fiscal_year_begin_date")
    first = F.col("period_number_current") == 1
    latest = F.when(first, F.lit(12)).otherwise(F.col("period_number_current") - 1)
    year = F.when(first, fy - 1).otherwise(fy)
    return cc.select(
        F.col("company").alias("company_code"), F.col("name").alias("company_name"),
        "fiscal_year_begin_date", fy.alias("fiscal_year"), "period_number_current",
        latest.alias("latest_closed_period"),
        concat_strict(year.cast("string"), lpad_number(latest, 2)).alias("closedperiod_yearmonthid"))


def profit_rows(profit_recognition: DataFrame, dim_date: DataFrame, codes: DataFrame) -> DataFrame:
    """Profit rows with calendar year/month and amounts in units.

    Record type 0 (project level, no profit data) and NULL types are
    dropped; the type is compared as a number.
    """
    pr = profit_recognition.filter(F.col("type_of_record").cast("int") != 0)
    pr = pr.join(dim_date, pr["date_effective"] == dim_date["julian_date"], "inner")
    pr = left_lookup(pr, codes, [("type_of_record", "user_defined_code")],
                     {"type_of_record_desc": "description"},
                     right_filter=(F.col("product_code") == RECORD_TYPE_CODES[0])
                     & (F.col("user_defined_codes") == RECORD_TYPE_CODES[1]))
    return pr.select(
        F.col("date_effective").alias("julian_date_effective"), "type_of_record",
        F.col("business_unit").alias("business_unit_code"), "type_of_record_desc",
        F.col("calendar_date").alias("date_effective"),
        F.year("calendar_date").alias("year_eff"), F.month("calendar_date").alias("month_eff"),
        *[hundredths(a).alias(a) for a in PROFIT_AMOUNTS],
        "date_updated", "time_last_updated")


def profit_months(profit: DataFrame) -> DataFrame:
    """Profit rows and the months (``_months``, an array) that each belongs to.

    One more row per (unit, year) has the months without a profit row, which may be none, and NULL measures: a balance
    row joined on (unit, year) meets every month. Each row is counted once for itself and once for its year, with
    partial aggregates; nothing is gathered per unit.
    """
    keys = ["business_unit_code", "year_eff"]
    measures = [f for f in profit.schema.fields if f.name.startswith("profit_recognition_")]
    bit = F.expr("shiftleft(1, month_eff)").alias("_seen")
    rows = profit.select(*keys, bit, F.monotonically_increasing_id().alias("_row"), *[f.name for f in measures])
    rows = rows.select(*keys, "_seen", F.explode(F.array(
        F.struct("_row", *[f.name for f in measures]),
        F.struct(F.lit(None).cast("bigint").alias("_row"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in measures])))
        .alias("_p")).select(*keys, "_seen", "_p.*")
    rows = rows.groupBy(*keys, "_row").agg(F.bit_or("_seen").alias("_seen"), *[F.first(f.name).alias(f.name) for f in measures])
    # own month, or the months that no row of the year has
    wanted = F.when(F.col("_row").isNull(), F.bitwise_not("_seen")).otherwise(F.col("_seen"))
    months = F.filter(F.array(*[F.lit(m) for m in range(1, 13)]), lambda m: F.getbit(wanted, m) == 1)
    return rows.select(*keys, months.alias("_months"), *[f.name for f in measures])


def ledger_wide(account_balances: DataFrame, account_master: DataFrame, business_unit_master: DataFrame,
                closed: DataFrame, codes: DataFrame, run_year: int | None) -> DataFrame:
    """Balance rows (still 12 month columns) with lookups and flags."""
    ab = account_balances.withColumn("fiscal_year", concat_strict(F.col("century"), F.col("fiscal_year")))
    if run_year is not None:
        ab = ab.filter(F.col("fiscal_year").cast("int") <= run_year)
    # Dimension lookups on the wide rows (12x fewer than after the unpivot).
    ab = left_lookup(ab, account_master, [("account_id", "account_id")],
                     {"account_level_of_detail": "account_level_of_detail"})
    ab = left_lookup(ab, business_unit_master, [("business_unit", "business_unit")],
                     {"business_unit_type": "business_unit_type",
                      "bu_status": "category_code_business_unit_17",
                      "project_manager_code": "address_number2"})
    ab = left_lookup(ab, closed, [("company", "company_code")],
                     {"latest_closed_period_year_month_id": "closedperiod_yearmonthid"})
    ab = left_lookup(ab, codes, [("ledger_types", "user_defined_code")],
                     {"ledger_type_desc": "description"},
                     right_filter=(F.col("product_code") == LEDGER_TYPE_CODES[0])
                     & (F.col("user_defined_codes") == LEDGER_TYPE_CODES[1]))
    sub, acct = F.col("subsidiary"), F.col("object_account")
    flags = ledger_flags(F.col("ledger_types"), F.col("business_unit_type"), acct,
                         F.col("business_unit"), F.col("account_level_of_detail"))
    return ab.select(
        "account_id", "fiscal_year",
        F.col("ledger_types").alias("ledger_type_code"), "ledger_type_desc", "subledger_g_l",
        "subledger_type", F.col("company").alias("company_code"),
        F.col("business_unit").alias("business_unit_code"), "business_unit_type", "bu_status",
        "project_manager_code", F.col("object_account").alias("object_account_code"),
        F.col("subsidiary").alias("account_subsidiary"),
        included_subsidiary(sub).alias("is_included_account_subsidiary"),
        "account_level_of_detail", account_category(sub, acct).alias("category"),
        hundredths("amount_beginning_balance_pye_forward").alias("amount_beginning_balance_pye_forward"),
        hundredths("amount_original_beginning_budget").alias("amount_original_beginning_budget"),
        *[v.alias(k) for k, v in flags.items()],
        "latest_closed_period_year_month_id", *MONTH_COLUMNS)


def ledger_rows(account_balances: DataFrame, account_master: DataFrame, business_unit_master: DataFrame,
                company_constants: DataFrame, dim_date: DataFrame, codes: DataFrame,
                profit_recognition: DataFrame, run_year: int | None, unique_profit: bool = False) -> DataFrame:
    """The ledger fact and ``fiscal_year`` (text) of each row, up to ``run_year`` if that is given.

    A filter on ``fiscal_year`` reaches the balances below the unpivot, as the column is not made by it.
    """
    closed = closed_periods(company_constants, dim_date)
    wide = ledger_wide(account_balances, account_master, business_unit_master, closed, codes, run_year)
    if unique_profit:
        profit_recognition = require_unique(
            profit_recognition, ["date_effective", "type_of_record", "business_unit"], "profit rows")
    profit = profit_rows(profit_recognition, dim_date, codes)
    profit = profit_months(add_profit_measures(
        profit, "projected_final_revenue_adjusted", "projected_final_cost_adjusted", "earned_job_to_date_revenue",
        "earned_job_to_date_cost", "actual_revenue_to_date", "actual_cost_to_date"))
    measures = [m for m in profit.columns if m.startswith("profit_recognition_")]
    # texts become numbers here, not once a month
    closed_period = "latest_closed_period_year_month_id"
    wide = wide.withColumns({"_year": F.col("fiscal_year").cast("bigint"), "_closed": F.col(closed_period).cast("bigint")})
    j = left_lookup(wide, profit, [("business_unit_code", "business_unit_code"), ("_year", "year_eff")],
                    {m: m for m in measures} | {"_months": "_months"})
    # without a profit row there is no loss
    j = j.withColumn("profit_recognition_accrued_loss", F.coalesce("profit_recognition_accrued_loss", F.lit(0)))
    keep = [c for c in j.columns if c not in [*MONTH_COLUMNS, "_months"]]
    j = unpivot_columns(j, MONTH_COLUMNS, keep, index_name="_month", value_name="amount_net_posting", divisor=100,
                        index_as_text=False, only=F.col("_months"))
    j = j.withColumns({"fiscal_month": F.col("_month").cast("string"), "year_month_id": period_id("_year", "_month")})
    j = j.withColumn("is_latest_closed_period_flag", closed_flag("year_month_id", "_closed"))
    return j.select(*FACT_COLUMNS, "fiscal_year")


def ledger_fact(account_balances: DataFrame, account_master: DataFrame, business_unit_master: DataFrame,
                company_constants: DataFrame, dim_date: DataFrame, codes: DataFrame,
                profit_recognition: DataFrame, run_ts: dt.datetime, unique_profit: bool = False) -> DataFrame:
    """The 49-column ledger fact (see module doc for the plan).

    ``unique_profit``: fail the job when a (date, record type, business unit)
    repeats among the profit rows, instead of multiplying the matching rows.
    """
    return ledger_rows(account_balances, account_master, business_unit_master, company_constants, dim_date, codes,
                       profit_recognition, run_ts.year, unique_profit).select(*FACT_COLUMNS)
