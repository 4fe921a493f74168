"""Input tables for the ledger plan, derived from the given TPC-H tables.

Every table here is computed by Spark from the given tables, so the work
of the registered queries grows with them.  The derivation rules are our
own (the original tables are not public); ``martkit.plans.oracle`` holds
the same rules in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.functions.dates import julian_key
from martkit.functions.numbers import to_cents
from martkit.sources.tables import date_dimension

# Fixed values of our derivation: ledger codes assigned to balance rows.
LEDGER_CODES = ["AA", "BA", "JA", "BU", "JU", "QA", "QU", "AU"]
# Record types that have a name.
RECORD_TYPES = ["0", "1"]


def bu_code(n: Column) -> Column:
    """Business-unit code of a 0..24 number; 20..24 map to the cost units 90090..90094."""
    return F.when(n >= 20, F.concat(F.lit("9009"), (n - 20).cast("string"))).otherwise(n.cast("string"))


def record_type(returnflag: Column) -> Column:
    return F.when(returnflag == "R", "0").when(returnflag == "A", "1").otherwise("2")


def object_account_rule(k: Column) -> Column:
    """Object account text from a whole number: revenue (5...), other
    (4...), the cost range 6000..6099, near misses of it (60990.., 60) and
    plain cost accounts (7...)."""
    pad3 = F.lpad((k % 1000).cast("string"), 3, "0")
    return (F.when(k % 6 == 0, F.concat(F.lit("5"), pad3))
            .when(k % 6 == 1, F.concat(F.lit("4"), pad3))
            .when(k % 6 == 2, F.concat(F.lit("60"), F.lpad((k % 100).cast("string"), 2, "0")))
            .when(k % 6 == 3, F.concat(F.lit("6099"), (k % 10).cast("string")))
            .when(k % 6 == 4, F.lit("60"))
            .otherwise(F.concat(F.lit("7"), pad3)))


def account_balances(orders: DataFrame) -> DataFrame:
    """One balance row per (customer, year, status, priority), 12 monthly
    amounts in cents (NULL for a month without orders)."""
    o = orders.select("o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
                      F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))
    cents = to_cents(F.col("o_totalprice"))
    g = o.groupBy("o_custkey", "y", "o_orderstatus", "o_orderpriority").agg(
        *[F.sum(F.when(F.col("m") == m, cents)).alias(f"amount_net_posting_{m:02d}") for m in range(1, 13)],
        F.sum(cents).alias("amount_beginning_balance_pye_forward"),
        (F.count(F.lit(1)) * F.lit(100000)).alias("amount_original_beginning_budget"))
    k = F.col("o_custkey")
    ys = F.col("y").cast("string")
    p = F.substring("o_orderpriority", 1, 1)
    account = object_account_rule(k)
    subsidiary = (F.when(p == "1", F.lit("99999955"))
                  .when(p == "2", F.concat(F.lit("99"), (k % 100).cast("string")))
                  .when(p == "3", F.concat(F.lit("8500"), (k % 10).cast("string")))
                  .when(p == "4", F.lit(None).cast("string"))
                  .otherwise((k % 1000).cast("string")))
    ledger = F.element_at(F.array(*[F.lit(c) for c in LEDGER_CODES]), ((k + F.col("y")) % 8 + 1).cast("int"))
    return g.select(
        k.cast("string").alias("account_id"),
        F.substring(ys, 1, 2).alias("century"), F.substring(ys, 3, 2).alias("fiscal_year"),
        ledger.alias("ledger_types"), p.alias("subledger_g_l"),
        F.col("o_orderstatus").alias("subledger_type"),
        (k % 6).cast("string").alias("company"), bu_code(k % 25).alias("business_unit"),
        account.alias("object_account"), subsidiary.alias("subsidiary"),
        *[f"amount_net_posting_{m:02d}" for m in range(1, 13)],
        "amount_beginning_balance_pye_forward", "amount_original_beginning_budget")


def account_master(customer: DataFrame) -> DataFrame:
    return customer.select(F.col("c_custkey").cast("string").alias("account_id"),
                           (F.col("c_nationkey") % 8).alias("account_level_of_detail"))


def business_unit_master(nation: DataFrame) -> DataFrame:
    r = F.col("n_regionkey")
    unit_type = (F.when(r == 0, "P1").when(r == 1, "P2").when(r == 2, F.lit(None).cast("string"))
                 .otherwise(F.concat(F.lit("X"), r.cast("string"))))
    return nation.select(bu_code(F.col("n_nationkey")).alias("business_unit"),
                         unit_type.alias("business_unit_type"),
                         F.col("n_name").alias("category_code_business_unit_17"),
                         r.cast("string").alias("address_number2"))


def company_constants(region: DataFrame) -> DataFrame:
    r = F.col("r_regionkey")
    return region.select(r.cast("string").alias("company"), F.col("r_name").alias("name"),
                         ((r * 5) % 12 + 1).alias("period_number_current"),
                         F.when(r == 4, F.lit(0)).otherwise((r + 1996) * 1000 + 1).alias("date_fiscal_year_begins"))


def dim_date(orders: DataFrame) -> DataFrame:
    return date_dimension(orders, "o_orderdate")


def profit_recognition(lineitem: DataFrame) -> DataFrame:
    """Profit rows per (first day of ship month, record type, business unit), in cents."""
    ext = F.col("l_extendedprice")
    net = to_cents(ext * (1 - F.col("l_discount")))
    g = lineitem.groupBy(
        julian_key(F.trunc("l_shipdate", "month")).alias("date_effective"),
        record_type(F.col("l_returnflag")).alias("type_of_record"),
        bu_code(F.col("l_suppkey") % 25).alias("business_unit"))
    return g.agg(
        (-F.sum(to_cents(ext))).alias("actual_revenue_to_date"),
        F.sum(net).alias("actual_cost_to_date"),
        (-F.sum(to_cents(ext * (1 + F.col("l_tax"))))).alias("projected_final_revenue"),
        F.sum(to_cents(ext)).alias("projected_final_cost"),
        (-F.sum(to_cents(ext * (1 + F.col("l_tax"))))).alias("projected_final_revenue_adjusted"),
        F.sum(F.when(F.col("l_quantity") > 49, to_cents(ext)).otherwise(0)).alias("projected_final_cost_adjusted"),
        F.sum(F.when(F.col("l_linestatus") == "F", -to_cents(ext)).otherwise(0)).alias("earned_job_to_date_revenue"),
        F.sum(F.when(F.col("l_linestatus") == "F", net).otherwise(0)).alias("earned_job_to_date_cost"),
        F.max(julian_key("l_shipdate")).alias("date_updated"),
        F.count(F.lit(1)).alias("time_last_updated"))


def code_values(spark: SparkSession) -> DataFrame:
    """Shared code table: record-type and ledger-type names plus decoy rows
    under other product codes (which the lookups must not pick up).
    Record type 2 and ledger QU have no name.  The codes are those of the
    rules above, so no table is read."""
    ledgers = [code for code in LEDGER_CODES if code != "QU"]
    rows = [(product, kind, code, f"{text} {code}") for product, kind, codes, text in (
        ("H50", "TY", RECORD_TYPES, "record type"), ("H50", "XX", RECORD_TYPES, "decoy"),
        ("09", "LT", ledgers, "ledger"), ("00", "LT", ledgers, "decoy")) for code in codes]
    names = ["product_code", "user_defined_codes", "user_defined_code", "description"]
    listed = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows])
    return spark.range(1).select(F.inline(listed))


def ledger_inputs(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All seven ledger input tables from the loaded TPC-H tables ``t``."""
    return {
        "account_balances": account_balances(t["orders"]),
        "account_master": account_master(t["customer"]),
        "business_unit_master": business_unit_master(t["nation"]),
        "company_constants": company_constants(t["region"]),
        "dim_date": dim_date(t["orders"]),
        "codes": code_values(t["orders"].sparkSession),
        "profit_recognition": profit_recognition(t["lineitem"]),
    }
