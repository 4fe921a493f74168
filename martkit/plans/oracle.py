"""DuckDB SQL for every registered query (the correctness oracle).

Views ``region nation customer supplier part orders lineitem events`` are the
given tables.  Business rules are small VALUES tables, measures come from one
formula table, and generated statements are spelled out as literal text, so a
wrong rule or layout in the Spark plans shows up here.  Column names and types
match the Spark results.
"""

from __future__ import annotations

import re


def BU(n: str) -> str:
    return f"(CASE WHEN {n} >= 20 THEN '9009' || CAST({n} - 20 AS VARCHAR) ELSE CAST({n} AS VARCHAR) END)"


def CENTS(x: str) -> str:
    return f"CAST(round({x} * 100) AS BIGINT)"


def JULIAN(d: str) -> str:
    return f"CAST(year({d}) * 1000 + dayofyear({d}) AS INTEGER)"


LEDGERS = "['AA', 'BA', 'JA', 'BU', 'JU', 'QA', 'QU', 'AU']"
SEGMENTS = "['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY']"
MONTHS = [f"amount_net_posting_{m:02d}" for m in range(1, 13)]


def ACCOUNT(k: str) -> str:
    return f"""(CASE WHEN {k} % 6 = 0 THEN '5' || lpad(CAST({k} % 1000 AS VARCHAR), 3, '0')
        WHEN {k} % 6 = 1 THEN '4' || lpad(CAST({k} % 1000 AS VARCHAR), 3, '0')
        WHEN {k} % 6 = 2 THEN '60' || lpad(CAST({k} % 100 AS VARCHAR), 2, '0')
        WHEN {k} % 6 = 3 THEN '6099' || CAST({k} % 10 AS VARCHAR)
        WHEN {k} % 6 = 4 THEN '60'
        ELSE '7' || lpad(CAST({k} % 1000 AS VARCHAR), 3, '0') END)"""


DIM_DATE = """dd AS (
  SELECT CAST(year(d) * 1000 + dayofyear(d) AS INTEGER) AS julian_date, CAST(d AS DATE) AS calendar_date
  FROM (SELECT unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE),
                                      INTERVAL 1 DAY)) AS d FROM orders))"""

_MONTH_SUMS = ",\n      ".join(
    f"CAST(sum(CASE WHEN m = {m} THEN cents END) AS BIGINT) AS amount_net_posting_{m:02d}" for m in range(1, 13))

BALANCES = f"""ab AS (
  SELECT CAST(o_custkey AS VARCHAR) AS account_id,
    substr(CAST(y AS VARCHAR), 1, 2) AS century, substr(CAST(y AS VARCHAR), 3, 2) AS fiscal_year,
    {LEDGERS}[((o_custkey + y) % 8) + 1] AS ledger_types,
    p AS subledger_g_l, o_orderstatus AS subledger_type,
    CAST(o_custkey % 6 AS VARCHAR) AS company, {BU('o_custkey % 25')} AS business_unit,
    {ACCOUNT('o_custkey')} AS object_account,
    CASE p WHEN '1' THEN '99999955' WHEN '2' THEN '99' || CAST(o_custkey % 100 AS VARCHAR)
           WHEN '3' THEN '8500' || CAST(o_custkey % 10 AS VARCHAR) WHEN '4' THEN NULL
           ELSE CAST(o_custkey % 1000 AS VARCHAR) END AS subsidiary,
    {", ".join(MONTHS)}, amount_beginning_balance_pye_forward, amount_original_beginning_budget
  FROM (
    SELECT o_custkey, y, o_orderstatus, o_orderpriority, substr(o_orderpriority, 1, 1) AS p,
      {_MONTH_SUMS},
      CAST(sum(cents) AS BIGINT) AS amount_beginning_balance_pye_forward,
      count(*) * 100000 AS amount_original_beginning_budget
    FROM (SELECT o_custkey, o_orderstatus, o_orderpriority, year(o_orderdate) AS y, month(o_orderdate) AS m,
                 {CENTS('o_totalprice')} AS cents FROM orders)
    GROUP BY o_custkey, y, o_orderstatus, o_orderpriority))"""

_MONTH_CASE = "CASE mm.m " + " ".join(f"WHEN {m} THEN amount_net_posting_{m:02d}" for m in range(1, 13)) + " END"


def balances_long(where: str = "") -> str:
    return f"""WITH {BALANCES},
long AS (
  SELECT account_id, century || fiscal_year AS fiscal_year, CAST(mm.m AS VARCHAR) AS fiscal_month,
    ledger_types AS ledger_type_code, subledger_type, subledger_g_l,
    CAST(century || fiscal_year AS BIGINT) * 100 + mm.m AS year_month_id,
    {_MONTH_CASE} / 100 AS amount_net_posting
  FROM ab CROSS JOIN range(1, 13) AS mm(m) {where})"""


Q: dict[str, str] = {}

Q["ledger_unpivot"] = balances_long() + "\nSELECT * FROM long"
Q["year_bound_early"] = balances_long("WHERE CAST(century || fiscal_year AS INTEGER) <= 1998") + "\nSELECT * FROM long"

# --- ledger fact ------------------------------------------------------------------
# Profit measures by output name, from the six amounts below.
AMOUNTS = {"planned_revenue": "abs(adj_rev)", "planned_cost": "adj_cost", "earned_revenue": "abs(earned_rev)",
           "earned_cost": "earned_cost", "booked_revenue": "actual_rev", "booked_cost": "actual_cost"}
MEASURES = {
    "adjusted_projected_final_revenue": "planned_revenue",
    "adjusted_projected_final_cost": "planned_cost",
    "projected_margin": "planned_revenue - planned_cost",
    "projected_margin_percent": "share(planned_revenue - planned_cost, planned_revenue)",
    "earned_revenue": "earned_revenue",
    "earned_cost": "earned_cost",
    "earned_margin": "earned_revenue - earned_cost",
    "earned_margin_percent": "share(earned_revenue - earned_cost, earned_revenue)",
    "backlog": "planned_revenue - booked_revenue",
    "actual_cost": "booked_cost",
    "percent_complete": "share(booked_cost, planned_cost)",
    "cost_of_revenue": "share(booked_cost, planned_cost) * planned_revenue",
    "actual_revenue": "booked_revenue",
    "remaining_to_complete_revenue": "planned_revenue - booked_revenue",
    "remaining_to_complete_cost": "planned_cost - booked_cost",
    "remaining_to_complete_margin": "(planned_revenue - booked_revenue) - (planned_cost - booked_cost)",
    "accrued_loss": "if(planned_revenue < planned_cost, 1, 0)",
}


def measures(amounts: dict[str, str]) -> str:
    """Select list of all measures; ``amounts`` names the six amounts in the source rows."""
    out = []
    for name, formula in MEASURES.items():
        formula = re.sub(r"share\((.+?), (\w+)\)", r"if(\2 = 0, 0.0, (\1) / \2)", formula)
        for amount, source in AMOUNTS.items():
            column = re.search(r"\w+(?=\)?$)", source)[0]
            formula = re.sub(rf"\b{amount}\b", f"({source.replace(column, amounts[column])})", formula)
        out.append(f"{formula} AS profit_recognition_{name}")
    return ",\n  ".join(out)


# Flag, kind of business unit it needs, ledger it needs.
_FLAG_RULES = [
    ("is_revised_amount", "plan", "BA"), ("is_revised_amount", "other", "JA"),
    ("is_orig_amt_flag", "plan", "BA"), ("is_orig_amt_flag", "other", "JA"),
    ("is_revised_unit", "plan", "BU"), ("is_revised_unit", "other", "JU"),
    ("is_orig_unit_flag", "plan", "BU"), ("is_orig_unit_flag", "other", "JU"),
    ("is_change_amount", "any", "QA"), ("is_actual_qty_flag", "any", "AU"), ("is_actual_amt_flag", "any", "AA"),
]
_RULE_FLAGS = list(dict.fromkeys(f for f, _, _ in _FLAG_RULES))
_RULE_ROWS = ", ".join(str(r) for r in _FLAG_RULES)
FLAGS = f"""flags AS (
  SELECT l.ledger, k.kind, {", ".join(f"CAST(count(*) FILTER (r.flag = '{f}') AS INTEGER) AS {f}" for f in _RULE_FLAGS)}
  FROM (SELECT unnest({LEDGERS}) AS ledger) l CROSS JOIN (VALUES ('plan'), ('other'), ('none')) k(kind)
  LEFT JOIN (VALUES {_RULE_ROWS}) r(flag, kind, ledger) ON r.ledger = l.ledger AND r.kind IN (k.kind, 'any')
  GROUP BY ALL)"""


def unit_kind(unit_type: str) -> str:
    return f"if({unit_type} IS NULL, 'none', if({unit_type} SIMILAR TO 'P[12]', 'plan', 'other'))"


def included(sub: str) -> str:
    return f"CAST(coalesce({sub} = '99999955' OR NOT starts_with({sub}, '99'), true) AS INTEGER)"


def category(sub: str, account: str) -> str:
    return (f"list_extract(['Cost', 'Other', 'Revenue'], CAST(greatest(1, 2 * CAST(starts_with({account}, '4') AS INTEGER), "
            f"3 * CAST(starts_with({account}, '5') OR coalesce(starts_with({sub}, '8500') OR {sub} = '99999955', false) "
            f"AS INTEGER)) AS INTEGER))")


def cost_to_date(ledger: str, account: str, unit: str) -> str:
    return f"CAST({ledger} = 'AA' AND (({account} >= '6000' AND {account} <= '6099') OR {unit} SIMILAR TO '9009[0-4]') AS INTEGER)"


# The month before the current period, which is a month of the fiscal year.
def closed_month(year: str, period: str) -> str:
    return f"strftime(make_date({year}, {period}, 1) - INTERVAL 1 MONTH, '%Y%m')"


_PROFIT = f"""profit AS (
  SELECT {BU('l_suppkey % 25')} AS unit, year(l_shipdate) AS y, month(l_shipdate) AS m, l_returnflag = 'A' AS named,
    sum(-{CENTS('l_extendedprice')}) / 100 AS actual_rev,
    sum({CENTS('l_extendedprice * (1 - l_discount)')}) / 100 AS actual_cost,
    sum(-{CENTS('l_extendedprice * (1 + l_tax)')}) / 100 AS adj_rev,
    sum(if(l_quantity > 49, {CENTS('l_extendedprice')}, 0)) / 100 AS adj_cost,
    sum(if(l_linestatus = 'F', -{CENTS('l_extendedprice')}, 0)) / 100 AS earned_rev,
    sum(if(l_linestatus = 'F', {CENTS('l_extendedprice * (1 - l_discount)')}, 0)) / 100 AS earned_cost
  FROM lineitem WHERE l_returnflag <> 'R'
    AND date_trunc('month', l_shipdate) BETWEEN (SELECT min(o_orderdate)::DATE FROM orders) AND (SELECT max(o_orderdate)::DATE FROM orders)
  GROUP BY ALL)"""

Q["ledger_fact"] = f"""WITH {BALANCES}, {FLAGS}, {_PROFIT},
units AS (
  SELECT {BU('n_nationkey')} AS unit, list_extract(['P1', 'P2', NULL, 'X3', 'X4'], CAST(n_regionkey + 1 AS INTEGER)) AS unit_type,
    n_name AS status, CAST(n_regionkey AS VARCHAR) AS manager
  FROM nation),
companies AS (
  SELECT CAST(r_regionkey AS VARCHAR) AS company,
    if(r_regionkey = 4, NULL, {closed_month('r_regionkey + 1996', '(r_regionkey * 5) % 12 + 1')}) AS closed
  FROM region),
months AS (
  SELECT ab.*, mm.m, CAST(ab.century || ab.fiscal_year AS INTEGER) AS y, {_MONTH_CASE} / 100 AS amount
  FROM ab CROSS JOIN range(1, 13) AS mm(m)),
rows_ AS (
  SELECT months.*, y * 100 + m AS period, units.unit_type, units.status, units.manager, companies.closed,
    c_nationkey % 8 AS detail, flags.* EXCLUDE (ledger, kind)
  FROM months
  LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = account_id
  LEFT JOIN units ON units.unit = business_unit
  LEFT JOIN companies USING (company)
  JOIN flags ON flags.ledger = ledger_types AND flags.kind = {unit_kind('units.unit_type')}
  WHERE y <= 1999)
SELECT CAST(period AS BIGINT) AS year_month_id, account_id, ledger_types AS ledger_type_code,
  if(ledger_types = 'QU', NULL, 'ledger ' || ledger_types) AS ledger_type_desc, subledger_g_l, subledger_type,
  company AS company_code, business_unit AS business_unit_code, unit_type AS business_unit_type, status AS bu_status,
  manager AS project_manager_code, object_account AS object_account_code, subsidiary AS account_subsidiary,
  {included('subsidiary')} AS is_included_account_subsidiary, detail AS account_level_of_detail,
  {category('subsidiary', 'object_account')} AS category, amount AS amount_net_posting,
  amount_beginning_balance_pye_forward / 100 AS amount_beginning_balance_pye_forward,
  amount_original_beginning_budget / 100 AS amount_original_beginning_budget,
  {", ".join(_RULE_FLAGS)},
  CAST(ledger_types = 'QU' AND detail = 7 AS INTEGER) AS is_change_unit,
  CAST(ledger_types = 'AA' AND starts_with(object_account, '5') AS INTEGER) AS is_bill_to_date_amt_flag,
  {cost_to_date('ledger_types', 'object_account', 'business_unit')} AS is_cost_to_date_amt_flag,
  {cost_to_date('ledger_types', 'object_account', 'business_unit')} AS is_prev_yr_cost_to_date_amt_flag,
  closed AS latest_closed_period_year_month_id,
  if(period > CAST(closed AS BIGINT), 0, 1) AS is_latest_closed_period_flag,
  {measures({n: n for n in ("adj_rev", "adj_cost", "earned_rev", "earned_cost", "actual_rev", "actual_cost")})}
FROM rows_ LEFT JOIN profit ON profit.unit = business_unit AND profit.y = rows_.y AND profit.m = rows_.m"""

# --- periods ------------------------------------------------------------------
# Fiscal years begin on the first of January; nation keys 3, 10, 17 and 24 have none.
_CUST_COMPANIES = f"""companies AS (
  SELECT CAST(c_custkey AS VARCHAR) AS company, c_name, c_custkey % 12 + 1 AS period,
    if(c_nationkey % 7 = 3, NULL, CAST(c_nationkey % 5 + 1995 AS INTEGER)) AS y, c_custkey
  FROM customer)"""

Q["closed_period"] = f"""WITH {_CUST_COMPANIES}
SELECT company AS company_code, c_name AS company_name, make_date(y, 1, 1) AS fiscal_year_begin_date, y AS fiscal_year,
  period AS period_number_current, (period + 10) % 12 + 1 AS latest_closed_period,
  {closed_month('y', 'period')} AS closedperiod_yearmonthid
FROM companies"""

Q["closed_flag"] = balances_long() + f""", {_CUST_COMPANIES},
known AS (SELECT company, {closed_month('y', 'period')} AS closed FROM companies WHERE c_custkey % 9 <> 0)
SELECT account_id, fiscal_year, fiscal_month, ledger_type_code, year_month_id,
  closed AS latest_closed_period_year_month_id,
  1 - CAST(coalesce(year_month_id > CAST(closed AS BIGINT), false) AS INTEGER) AS is_latest_closed_period_flag
FROM long LEFT JOIN known ON account_id = company"""

Q["julian_dates"] = f"""WITH {DIM_DATE}
SELECT o.o_orderkey, dd.julian_date, dd.calendar_date, nx.calendar_date AS next_calendar_date
FROM orders o JOIN dd ON dd.julian_date = {JULIAN('o.o_orderdate')}
LEFT JOIN dd nx ON nx.julian_date = dd.julian_date + 1"""

Q["code_lookup"] = """WITH codes AS (
  SELECT CASE WHEN n_regionkey % 2 = 0 THEN 'H50' ELSE '09' END AS product_code,
    CASE WHEN n_nationkey % 3 = 0 THEN 'XX' ELSE 'TY' END AS user_defined_codes,
    CAST(n_nationkey AS VARCHAR) AS user_defined_code, n_name AS description FROM nation)
SELECT c.c_custkey, c.c_nationkey, codes.description AS nation_desc, n.n_regionkey
FROM customer c
LEFT JOIN codes ON CAST(c.c_nationkey AS VARCHAR) = codes.user_defined_code
  AND codes.product_code = 'H50' AND codes.user_defined_codes = 'TY'
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE c.c_mktsegment = 'BUILDING'"""

Q["prefix_flags"] = """WITH p AS (
  SELECT p_partkey,
    CASE WHEN p_partkey % 5 = 0 THEN '99' || CAST(p_partkey AS VARCHAR) WHEN p_partkey % 5 = 1 THEN '99999955'
         WHEN p_partkey % 5 = 2 THEN '8500' || CAST(p_partkey % 10 AS VARCHAR) WHEN p_partkey % 5 = 3 THEN NULL
         ELSE CAST(p_partkey % 1000 AS VARCHAR) END AS account_subsidiary,
    CASE WHEN p_partkey % 3 = 0 THEN '5' || CAST(p_size AS VARCHAR) WHEN p_partkey % 3 = 1 THEN '4' || CAST(p_size AS VARCHAR)
         ELSE '6' || CAST(p_size AS VARCHAR) END AS object_account_code
  FROM part)
SELECT *, """ + included("account_subsidiary") + """ AS is_included_account_subsidiary,
  """ + category("account_subsidiary", "object_account_code") + """ AS category
FROM p"""

Q["list_flags"] = f"""WITH {FLAGS}, o AS (
  SELECT o_orderkey, {LEDGERS}[(o_orderkey % 8) + 1] AS ledger_type_code,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'P1' WHEN '2' THEN 'P2' WHEN '3' THEN NULL
         ELSE 'X' || substr(o_orderpriority, 1, 1) END AS business_unit_type,
    o_custkey % 8 AS account_level_of_detail, {ACCOUNT('o_orderkey')} AS object_account_code
  FROM orders)
SELECT o.*, flags.* EXCLUDE (ledger, kind),
  CAST(ledger_type_code = 'QU' AND account_level_of_detail = 7 AS INTEGER) AS is_change_unit,
  CAST(ledger_type_code = 'AA' AND starts_with(object_account_code, '5') AS INTEGER) AS is_bill_to_date_amt_flag
FROM o JOIN flags ON ledger = ledger_type_code AND kind = {unit_kind('business_unit_type')}"""

Q["string_between"] = f"""WITH p AS (
  SELECT p_partkey, ['6000', '6099', '60995', '60', '6000.10', '6050', '5999'][(p_partkey % 7) + 1] AS object_account_code,
    CASE WHEN p_partkey % 2 = 0 THEN 'AA' ELSE 'BA' END AS ledger_type_code,
    {BU('p_size % 25')} AS business_unit_code
  FROM part),
f AS (SELECT *, {cost_to_date('ledger_type_code', 'object_account_code', 'business_unit_code')} AS flag FROM p)
SELECT f.* EXCLUDE (flag), flag AS is_cost_to_date_amt_flag, flag AS is_prev_yr_cost_to_date_amt_flag FROM f"""

Q["profit_measures"] = f"""WITH g AS (
  SELECT l_suppkey,
    -CAST(sum({CENTS('l_extendedprice * (1 + l_tax)')}) AS BIGINT) AS adj_rev_c,
    CAST(sum({CENTS('l_extendedprice')}) AS BIGINT) AS cost_c,
    CAST(sum(CASE WHEN l_linestatus = 'F' THEN -{CENTS('l_extendedprice')} ELSE 0 END) AS BIGINT) AS earned_rev_c,
    CAST(sum(CASE WHEN l_linestatus = 'F' THEN {CENTS('l_extendedprice * (1 - l_discount)')} ELSE 0 END) AS BIGINT)
      AS earned_cost_c,
    -CAST(sum({CENTS('l_extendedprice * (1 - l_discount)')}) AS BIGINT) AS actual_rev_c,
    CAST(sum({CENTS('l_extendedprice * l_discount')}) AS BIGINT) AS actual_cost_c
  FROM lineitem GROUP BY l_suppkey),
u AS (
  SELECT l_suppkey, adj_rev_c / 100 AS adj_rev, if(l_suppkey % 7 = 0, 0, cost_c) / 100 AS adj_cost,
    earned_rev_c / 100 AS earned_rev, earned_cost_c / 100 AS earned_cost, actual_rev_c / 100 AS actual_rev,
    actual_cost_c / 100 AS actual_cost
  FROM g)
SELECT l_suppkey, {measures({n: n for n in ("adj_rev", "adj_cost", "earned_rev", "earned_cost", "actual_rev", "actual_cost")})}
FROM u"""

Q["profit_fanout"] = f"""WITH o AS (
  SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS fiscal_year, CAST(month(o_orderdate) AS VARCHAR) AS fiscal_month,
    {BU('o_custkey % 25')} AS business_unit_code FROM orders),
pr AS (
  SELECT {BU('l_suppkey % 25')} AS bu, year(l_shipdate) AS y, month(l_shipdate) AS m, l_returnflag AS type_of_record,
    CAST(sum({CENTS('l_extendedprice')}) AS BIGINT) AS rev_c
  FROM lineitem GROUP BY 1, 2, 3, 4)
SELECT o.o_orderkey, o.fiscal_year, o.fiscal_month, o.business_unit_code, pr.type_of_record, pr.rev_c / 100 AS actual_revenue
FROM o LEFT JOIN pr ON o.business_unit_code = pr.bu AND CAST(o.fiscal_year AS INTEGER) = pr.y
  AND CAST(o.fiscal_month AS INTEGER) = pr.m"""

Q["not_equal_filter"] = """SELECT o_orderkey, type_of_record
FROM (SELECT o_orderkey, nullif(CAST(o_orderkey % 5 AS VARCHAR), '3') AS type_of_record FROM orders)
WHERE CAST(type_of_record AS INTEGER) <> 0"""

Q["presum_having"] = """SELECT l_orderkey AS object_id, l_suppkey % 4 AS database_id, l_returnflag AS ServerName,
  l_linestatus AS ClientName, CAST(sum(CAST(l_quantity AS BIGINT) - 25) AS BIGINT) AS "rows"
FROM lineitem WHERE l_linenumber % 3 < 2
GROUP BY 1, 2, 3, 4 HAVING sum(CAST(l_quantity AS BIGINT) - 25) <> 0"""

Q["group_dedupe"] = """SELECT DISTINCT c.c_mktsegment, c.c_nationkey, o.o_orderstatus
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey"""

Q["distinct_pairs"] = "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer"

Q["best_row"] = """WITH r AS (
  SELECT o_custkey, o_orderkey, o_orderpriority, o_orderdate,
    row_number() OVER (PARTITION BY o_custkey ORDER BY
      CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 ELSE 4 END,
      o_orderdate, o_orderkey) AS rn
  FROM orders)
SELECT c.c_custkey, c.c_name, r.o_orderkey, r.o_orderpriority, r.o_orderdate
FROM customer c LEFT JOIN r ON c.c_custkey = r.o_custkey AND r.rn = 1"""

Q["key_flag"] = """SELECT o_orderkey, o_custkey,
  CASE WHEN count(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END) OVER (PARTITION BY o_custkey) = 0
       THEN 1 ELSE 0 END AS has_no_pk
FROM orders"""

Q["composite_left"] = """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, o.o_custkey, p.p_name
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey AND l.l_linenumber % 3 = o.o_custkey % 3
LEFT JOIN part p ON l.l_partkey = p.p_partkey AND o.o_custkey % 3 = p.p_size % 3"""

Q["trim_null_join"] = """WITH l AS (SELECT p_partkey, '  ' || p_name || ' ' AS padded_name FROM part),
dc AS (SELECT DISTINCT p_name AS delta_column, CASE WHEN length(p_name) % 2 = 0 THEN NULL ELSE 'T' END AS table_name FROM part)
SELECT l.p_partkey, l.padded_name, dc.delta_column
FROM l LEFT JOIN dc ON trim(l.padded_name) = dc.delta_column AND dc.table_name IS NULL"""

_COLUMN_ROWS = """cr AS (
  SELECT c_custkey, 'S' || CAST(c_nationkey % 3 AS VARCHAR) AS source_name, 'T' || CAST(c_custkey % 10 AS VARCHAR) AS table_name,
    c_mktsegment AS client_name, 'col' || CAST(c_custkey % 4 AS VARCHAR) AS column_name
  FROM customer)"""

Q["tiered_lookup"] = f"""WITH {_COLUMN_ROWS},
dc AS (
  SELECT 'S' || CAST(n_nationkey % 3 AS VARCHAR) AS SourceName, 'col' || CAST(n_nationkey % 4 AS VARCHAR) AS DeltaColumn,
    CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE 'T' || CAST(n_nationkey % 10 AS VARCHAR) END AS TableName,
    CASE WHEN n_nationkey % 2 = 0 THEN NULL ELSE {SEGMENTS}[(n_nationkey % 5) + 1] END AS ClientName,
    'dc_' || CAST(n_nationkey AS VARCHAR) AS value
  FROM nation)
-- an entry for a client also names a table; the entry that names most wins
SELECT c_custkey, arg_max(value, CAST(TableName IS NOT NULL AS INTEGER) + CAST(dc.ClientName IS NOT NULL AS INTEGER))
    AS delta_column
FROM cr LEFT JOIN dc ON source_name = SourceName AND column_name = DeltaColumn
  AND coalesce(TableName = table_name, dc.ClientName IS NULL) AND coalesce(dc.ClientName = client_name, true)
GROUP BY c_custkey"""

Q["block_list"] = f"""WITH {_COLUMN_ROWS},
ex AS (
  SELECT 'S' || CAST(n_nationkey % 3 AS VARCHAR) AS SourceName, 'T' || CAST(n_nationkey % 10 AS VARCHAR) AS TableNameForExclusion,
    CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE 'col' || CAST(n_nationkey % 4 AS VARCHAR) END AS ColumnNameForExclusion,
    CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE {SEGMENTS}[(n_nationkey % 5) + 1] END AS ClientName
  FROM nation),
hits AS (
  SELECT c_custkey, bool_or(ColumnNameForExclusion IS NULL AND TableNameForExclusion IS NOT NULL) AS whole_table,
    bool_or(ColumnNameForExclusion = column_name) AS this_column
  FROM cr LEFT JOIN ex ON source_name = SourceName AND table_name = TableNameForExclusion
    AND (ClientName = client_name OR ClientName IS NULL)
  GROUP BY c_custkey)
SELECT c_custkey, CAST(coalesce(whole_table, false) AS INTEGER) AS exclude_table
FROM hits WHERE NOT coalesce(this_column, false)"""

Q["allow_list"] = f"""WITH {_COLUMN_ROWS},
inc AS (
  SELECT 'S' || CAST(n_nationkey % 3 AS VARCHAR) AS SourceName, {SEGMENTS}[(n_nationkey % 5) + 1] AS ClientName,
    'T' || CAST(n_nationkey % 10 AS VARCHAR) AS TableNameForInclusion
  FROM nation),
listed AS (SELECT SourceName, ClientName, list(TableNameForInclusion) AS tables FROM inc GROUP BY ALL)
SELECT c_custkey, CAST(NOT list_contains(coalesce(tables, [table_name]), table_name) AS INTEGER) AS exclude_table
FROM cr LEFT JOIN listed ON source_name = SourceName AND client_name = ClientName"""

# --- ordered text and statements ------------------------------------------------
_ITEM = "printf('[col %d] AS [col_%d]', l_partkey, l_partkey)"
_LINE_ORDER = "ORDER BY l_linenumber, l_partkey, l_suppkey"


def statement(columns: str, server: str, database: str, table: str) -> str:
    """The generated select statement (NULL if any part is)."""
    return (rf"E'SELECT \n\t\t' || {columns} || E' \n\t\t, \'' || {server} || E'\' AS [SourceServerName] \n\t\t, \'' || "
            rf"{database} || E'\' AS [SourceDatabaseName] \n\t FROM [' || {database} || '].' || {table} || ' WITH (NOLOCK)'")


Q["ordered_text"] = rf"""SELECT l_orderkey, string_agg({_ITEM}, E'\n\t\t, ' {_LINE_ORDER}) AS select_list
FROM lineitem GROUP BY l_orderkey"""

Q["ordered_text_skip_null"] = rf"""SELECT l_orderkey,
  string_agg({_ITEM}, E'\n        , ' {_LINE_ORDER}) FILTER (l_returnflag = 'R') AS key_list
FROM lineitem GROUP BY l_orderkey"""

Q["select_text"] = rf"""WITH g AS (
  SELECT l_orderkey AS k, string_agg({_ITEM}, E'\n\t\t, ' {_LINE_ORDER}) AS list FROM lineitem GROUP BY l_orderkey)
SELECT k AS l_orderkey, {statement("list", "'srv' || k % 3", "if(k % 11 = 0, NULL, 'DB' || k % 5)", "'[dbo].[T' || k || ']'")}
  AS source_select_statement
FROM g"""

Q["key_text"] = rf"""WITH g AS (
  SELECT o_custkey AS k,
    string_agg(printf('[k %d] AS [k_%d]', o_orderkey, o_orderkey), E'\n        , ' ORDER BY o_orderkey)
      FILTER (o_orderpriority = '1-URGENT') AS keys,
    string_agg(printf('t.k %d = s.k %d', o_orderkey, o_orderkey), E'\n\t\t\tAND ' ORDER BY o_orderkey)
      FILTER (o_orderpriority = '1-URGENT') AS clauses
  FROM orders GROUP BY o_custkey)
SELECT k AS o_custkey, CAST(keys IS NULL AS INTEGER) AS has_no_pk,
  {statement("keys", "'srv'", "'DB' || k % 5", "'[dbo].[C' || k || ']'")} AS source_select_pk_statement,
  E'\n\t\t' || clauses || E'\n\t\t\t' AS primary_key_merge_statement,
  if(keys IS NULL, NULL, 'dbo_C' || k || '_PK.parquet') AS primary_key_file_name
FROM g"""

Q["active_delta"] = """WITH li AS (
  SELECT l_partkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS rows_,
    max(CASE WHEN l_returnflag = 'R' THEN 'modified_' || l_linestatus END) AS delta
  FROM lineitem GROUP BY l_partkey)
SELECT p.p_partkey, COALESCE(li.rows_, 0) AS source_row_count,
  CASE WHEN p.p_size % 10 = 0 OR COALESCE(li.rows_, 0) = 0 THEN 0 ELSE 1 END AS is_table_considered_active,
  CASE WHEN li.delta IS NULL THEN 0 ELSE 1 END AS is_delta, li.delta AS delta_column
FROM part p LEFT JOIN li ON p.p_partkey = li.l_partkey"""

# --- control table -----------------------------------------------------------------
# Built from the orders themselves: an order that is not 'P' is a user table, its
# line numbers are its columns. Server, database, client and schema follow from the key.
Q["control_table"] = rf"""WITH
sizes AS (
  SELECT l_orderkey AS k, sum(CAST(l_quantity AS BIGINT)) AS n
  FROM lineitem WHERE l_returnflag <> 'N' AND l_linenumber % 3 IN (0, 1) GROUP BY l_orderkey),
excluded AS (SELECT n_nationkey * 2 + n_nationkey % 2 AS k, if(n_nationkey % 5 = 0, n_nationkey % 7 + 1, NULL) AS col FROM nation),
listed AS (SELECT n_nationkey * 6 + 1 AS k FROM nation WHERE n_nationkey % 4 <> 0),
tabs AS (
  SELECT o_orderkey AS k, list_extract(['dbo', 'sales', 'hr'], CAST(o_orderkey % 4 + 1 AS INTEGER)) AS schema_name,
    if(o_orderkey % 2 = 0, 'ERP', 'CRM') AS system, coalesce(sizes.n, 0) AS size,
    -- first key column and last key column of the best unique index
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN [1, 2] WHEN o_orderstatus = 'F' THEN [3, 999999] END AS span,
    o_orderkey IN (SELECT k FROM excluded WHERE col IS NULL)
      OR (o_orderkey % 6 = 1 AND NOT (o_orderkey % 4 < 3 AND o_orderkey IN (SELECT k FROM listed))) AS hidden
  FROM orders LEFT JOIN sizes ON sizes.k = o_orderkey WHERE o_orderstatus <> 'P'),
deltas AS (
  SELECT n_nationkey AS n, n_nationkey % 7 + 1 AS col, if(n_nationkey % 2 = 0, 'ERP', 'CRM') AS system,
    n_nationkey % 3 <> 0 AS one_table, n_nationkey % 4 = 1 AS one_client
  FROM nation),
cols AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS c FROM lineitem),
col_rows AS (
  SELECT tabs.*, c, coalesce(c BETWEEN span[1] AND span[2], false) AS is_key,
    if(c <= 6 AND schema_name IS NOT NULL, 100 - c, NULL) AS place,
    EXISTS (SELECT 1 FROM deltas WHERE deltas.system = tabs.system AND col = c AND
            if(one_client, one_table AND n = tabs.k, NOT one_table OR n = tabs.k)) AS is_delta,
    EXISTS (SELECT 1 FROM excluded WHERE excluded.k = tabs.k AND col = c) AS is_hidden
  FROM tabs LEFT JOIN cols USING (k)),
texts AS (
  SELECT k, schema_name, system, size, hidden,
    string_agg(printf('[col %d] AS [col_%d]', c, c), E'\n\t\t, ' ORDER BY place NULLS FIRST, c)
      FILTER (NOT is_hidden AND c IS NOT NULL) AS list,
    string_agg(printf('[col %d] AS [col_%d]', c, c), E'\n        , ' ORDER BY place NULLS FIRST, c)
      FILTER (is_key AND NOT is_hidden) AS keys,
    string_agg(printf('t.col %d = s.col %d', c, c), E'\n\t\t\tAND ' ORDER BY place NULLS FIRST, c)
      FILTER (is_key AND NOT is_hidden) AS clauses,
    bool_or(is_key) AS has_key, max('col ' || c) FILTER (is_delta AND NOT is_hidden) AS delta
  FROM col_rows GROUP BY ALL HAVING bool_or(NOT is_hidden))
SELECT 'client' || k % 3 AS ClientName, 'lake' AS DataLakeName, 'sql' AS SourceDataStructure,
  system AS SourceSystemName, 'srv' || k % 2 AS SourceServerName, 'db' || (k % 2 + 1) AS SourceDatabaseName,
  schema_name AS SourceSchemaName, 'T' || k AS SourceTableName, CAST(size AS BIGINT) AS SourceRowCount,
  {statement("list", "'srv' || k % 2", "'db' || (k % 2 + 1)", "'[' || schema_name || '].[T' || k || ']'")} AS SourceSelectStatement,
  {statement("keys", "'srv' || k % 2", "'db' || (k % 2 + 1)", "'[' || schema_name || '].[T' || k || ']'")} AS SourceSelectPKStatement,
  if(has_key, E'\n\t\t' || coalesce(clauses, '') || E'\n\t\t\t', NULL) AS PrimaryKeyMergeStatement,
  coalesce(schema_name, '') || '_T' || k || '.parquet' AS StagingDataFileName,
  if(has_key, coalesce(schema_name, '') || '_T' || k || '_PK.parquet', NULL) AS PrimaryKeyFileName,
  CAST(size <> 0 AND NOT hidden AS INTEGER) AS IsTableConsideredActive,
  CAST(delta IS NOT NULL AS INTEGER) AS IsDelta, delta AS DeltaColumn,
  CAST(NULL AS VARCHAR) AS DeltaValue, 100 AS SequenceNumber
FROM texts"""

# --- upsert -------------------------------------------------------------------------


def _upsert_sql(stamp: bool, only_changed: bool) -> str:
    amount = ("CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END" if only_changed
              else "o_totalprice + 1")
    status = "o_orderstatus" if only_changed else "'U'"
    t_stamp = ", o_orderdate AS etl_modified_date" if stamp else ""
    vals = ["amount", "status", "priority"]
    matched = "t._tgt AND s._src"
    if only_changed:
        changed = " OR ".join(f"t.{v} IS DISTINCT FROM s.{v}" for v in vals)
        updated = f"({matched} AND ({changed}))"
    else:
        updated = f"({matched})"
    take_src = f"(t._tgt IS NULL OR {updated})"
    out = [f"CASE WHEN s._src THEN s.{k} ELSE t.{k} END AS {k}"
           for k in ["native_transaction_id", "native_transaction_line_id"]]
    out += [f"CASE WHEN {take_src} THEN s.{v} ELSE t.{v} END AS {v}" for v in vals]
    if stamp:
        out.append(f"CASE WHEN {updated} THEN TIMESTAMP '2024-02-01 00:00:00' WHEN t._tgt IS NULL THEN NULL "
                   f"ELSE t.etl_modified_date END AS etl_modified_date")
    return f"""WITH t AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS native_transaction_id, CAST(o_custkey AS VARCHAR) AS native_transaction_line_id,
    o_totalprice AS amount, o_orderstatus AS status, o_orderpriority AS priority{t_stamp}, true AS _tgt
  FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
s AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS native_transaction_id,
    CASE WHEN o_orderpriority = '5-LOW' AND o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END
      AS native_transaction_line_id,
    {amount} + (copy - 1) AS amount, {status} AS status, o_orderpriority AS priority, true AS _src
  FROM orders, range(1, if(o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderkey % 50 = 0, 3, 2)) AS r(copy)
  WHERE o_orderdate >= TIMESTAMP '1998-01-01')
SELECT {", ".join(out)}
FROM t FULL OUTER JOIN s ON t.native_transaction_id = s.native_transaction_id
  AND t.native_transaction_line_id = s.native_transaction_line_id"""


Q["upsert"] = _upsert_sql(False, False)
Q["upsert_stamp"] = _upsert_sql(True, False)
Q["upsert_changed_only"] = _upsert_sql(True, True)

# --- landing -------------------------------------------------------------------------
Q["envelope"] = """WITH p AS (
  SELECT event_id,
    from_json('{"value": [' || props || ', {"k": null, "extra": "x"}]}', '{"value": [{"k": "INTEGER"}]}').value AS arr
  FROM events)
SELECT event_id, CAST(i - 1 AS INTEGER) AS pos, arr[i].k AS k FROM p, range(1, len(arr) + 1) AS r(i)"""

Q["pages_until_error"] = """WITH pages AS (
  SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_linenumber + (l_suppkey % 13 = 0)::INTEGER AS INTEGER) AS page_no,
    CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_partkey % 19 = 0 THEN 500 ELSE 200 END AS status,
    CASE WHEN l_linenumber < 6 AND l_quantity > 2 THEN 'next' || l_partkey END AS link
  FROM lineitem),
numbers AS (
  SELECT l_orderkey, page_no, bool_and(coalesce(status = 200, false)) AS good,
    bool_or(coalesce(status = 200, false) AND link IS NULL) AS last
  FROM pages GROUP BY ALL),
walk AS (
  SELECT *, row_number() OVER w = page_no AND coalesce(bool_and(good) OVER w, false) AS reached,
    coalesce(bool_or(last) OVER (PARTITION BY l_orderkey ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
             false) AS ended
  FROM numbers WINDOW w AS (PARTITION BY l_orderkey ORDER BY page_no)),
kept AS (
  SELECT l_orderkey, page_no, last_value(last) OVER (PARTITION BY l_orderkey ORDER BY page_no
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS complete
  FROM walk WHERE reached AND NOT ended)
SELECT pages.*, kept.complete FROM pages JOIN kept USING (l_orderkey, page_no)"""

Q["day_windows"] = """WITH w AS (
  SELECT window_day, CAST(window_day AS TIMESTAMP) AS ws, CAST(window_day AS TIMESTAMP) + INTERVAL 1 DAY AS we,
    strftime(window_day, '%Y%m%d') AS load_date
  FROM (SELECT CAST(DATE '2024-01-31' - CAST(d AS INTEGER) AS DATE) AS window_day FROM range(1, 31) AS r(d)))
SELECT e.event_id, strftime(w.ws, '%Y-%m-%dT%H:%M:%SZ') AS start_datetime,
  strftime(w.we, '%Y-%m-%dT%H:%M:%SZ') AS end_datetime, w.load_date
FROM events e JOIN w ON CAST(e.ts AS DATE) = w.window_day AND e.ts >= w.ws AND e.ts < w.we"""

Q["partition_merge"] = """SELECT o_orderkey AS native_transaction_id, CAST(year(o_orderdate) AS INTEGER) AS order_year,
  if(hit, o_totalprice + 1, o_totalprice) AS amount, if(hit, 'U', o_orderstatus) AS status
FROM (SELECT *, year(o_orderdate) >= 1997 AND o_orderkey % 4 < 2 AS hit FROM orders)
WHERE hit OR o_orderkey % 10 <> 0"""

Q["ledger_fact_sql"], Q["profit_measures_sql"] = Q["ledger_fact"], Q["profit_measures"]

_BODIES = """bodies AS (
  SELECT event_id, CASE event_id % 11 WHEN 3 THEN substr(body, 1, 12) WHEN 5 THEN '' WHEN 7 THEN '{"error": "forbidden"}'
    WHEN 9 THEN '{"value": []}' ELSE body END AS body
  FROM (SELECT event_id, '{"value": [{"id": ' || event_id ||
          CASE event_id % 4 WHEN 0 THEN ', "k": ' || k WHEN 1 THEN ', "k": "n' || k || '"' WHEN 2 THEN ', "k": {"v":' || k || '}' ELSE '' END
          || '}, {"id": null}], "next": "' || event_id || '"}' AS body
        FROM (SELECT event_id, regexp_extract(props, '[0-9]+') AS k FROM events)))"""

Q["rejected_pages"] = f"""WITH {_BODIES}
SELECT event_id, CASE WHEN body = '' OR NOT json_valid(body) THEN 'not JSON' WHEN NOT json_exists(body, '$.value') THEN 'no ''value'' list' END
    AS reason,
  if(json_valid(body) AND body <> '', CAST(json_array_length(body, '$.value') AS INTEGER), NULL) AS n_rows
FROM bodies"""

Q["variant_rows"] = f"""WITH {_BODIES},
rows_ AS (
  SELECT event_id, i, json_extract(body, '$.value[' || i || ']') AS row_
  FROM bodies, range(2) AS r(i) WHERE json_valid(body) AND body <> '')
SELECT event_id, CAST(i AS INTEGER) AS pos, CAST(row_ ->> '$.id' AS BIGINT) AS id, row_ ->> '$.k' AS k,
  CAST(coalesce(json_type(row_, '$.k') IN ('OBJECT', 'VARCHAR'), false) AS INTEGER) AS unfit_as_int
FROM rows_ WHERE row_ IS NOT NULL"""

Q["day_audit"] = """WITH pulls AS (
  SELECT strftime(ts, '%Y%m%d') AS load_day, bool_or(event_type = 'error' AND value > 20 AND day(ts) % 4 = 1) AS failed
  FROM events WHERE day(ts) % 6 <> 0 GROUP BY load_day, user_id % 2)
SELECT strftime(d, '%Y%m%d') AS load_day,
  CASE WHEN count(load_day) = 0 THEN 'absent' WHEN bool_and(failed) THEN 'incomplete' ELSE 'complete' END AS status
FROM (SELECT unnest(generate_series(DATE '2024-01-31' - INTERVAL 35 DAY, DATE '2024-01-30', INTERVAL 1 DAY)) AS d)
LEFT JOIN pulls ON load_day = strftime(d, '%Y%m%d') GROUP BY d"""

_TEXTS = ["ClientName", "DataLakeName", "SourceDataStructure", "SourceSystemName", "SourceServerName", "SourceDatabaseName",
          "SourceSchemaName", "SourceTableName", "SourceSelectStatement", "SourceSelectPKStatement", "PrimaryKeyMergeStatement",
          "StagingDataFileName", "PrimaryKeyFileName", "DeltaColumn", "DeltaValue"]
Q["control_table_nocase"] = (f"SELECT * REPLACE ({', '.join(f'lower({t}) AS {t}' for t in _TEXTS)}) "
                             f"FROM ({Q['control_table']})")

# --- what the control table leaves out; keys of the block and allow lists as in control_table
Q["control_drops"] = """WITH tabs AS (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus <> 'P'),
cols AS (SELECT k, n FROM tabs LEFT JOIN (SELECT DISTINCT l_orderkey, l_linenumber AS n FROM lineitem) ON l_orderkey = k),
blocked AS (SELECT n_nationkey * 2 + n_nationkey % 2 AS k, if(n_nationkey % 5 = 0, n_nationkey % 7 + 1, NULL) AS n FROM nation),
allowed AS (SELECT n_nationkey * 6 + 1 AS k FROM nation WHERE n_nationkey % 4 <> 0),
marked AS (
  SELECT cols.*, EXISTS (SELECT 1 FROM blocked b WHERE b.k = cols.k AND b.n = cols.n) AS gone,
    EXISTS (SELECT 1 FROM blocked b WHERE b.k = cols.k AND b.n IS NULL)
      OR (k % 6 = 1 AND (k % 4 = 3 OR k NOT IN (SELECT k FROM allowed))) AS inactive
  FROM cols)
SELECT count(*) AS column_rows, count(*) FILTER (n IS NULL) AS tables_without_columns, count(*) FILTER (gone) AS excluded_columns,
  count(*) FILTER (n > 6 OR (n IS NOT NULL AND k % 4 = 3)) AS columns_without_position, CAST(0 AS BIGINT) AS rows_without_table,
  count(*) FILTER (k % 4 = 3) AS rows_without_schema, CAST(0 AS BIGINT) AS rows_without_source, count(*) FILTER (inactive) AS rows_of_inactive_tables
FROM marked"""

# Every link of a chain is followed by recursion; a page met again ends the walk.
Q["link_chains"] = """WITH RECURSIVE sized AS (
  SELECT o_orderkey AS k, o_orderkey // 1000 AS chain, o_orderkey % 1000 AS place, 1 + (o_orderkey // 1000) * 37 % 1000 AS size
  FROM orders),
links AS (
  SELECT *, CASE WHEN place <> size - 1 THEN k + 1 WHEN chain % 7 = 3 THEN chain * 1000 + size // 2
                 WHEN chain % 7 = 4 THEN -1 END AS target,
    CASE WHEN k % 1009 = 1008 THEN NULL WHEN k % 2003 = 2002 THEN 500 ELSE 200 END AS status,
    chain % 7 = 5 AND place = size // 3 AS fork
  FROM sized),
good AS (SELECT * FROM links WHERE status = 200 AND NOT (fork AND target IS NOT NULL)),
walk AS (
  SELECT chain, k, target, 0 AS steps FROM good WHERE place = 0
  UNION ALL
  SELECT g.chain, g.k, g.target, steps + 1 FROM walk JOIN good g ON g.chain = walk.chain AND g.k = walk.target WHERE steps < 2000),
got AS (SELECT chain, k, min(steps) AS page_rank FROM walk GROUP BY ALL),
whole AS (SELECT chain, bool_or(target IS NULL) AS complete FROM walk GROUP BY chain)
SELECT chain, 'page ' || k AS address, CAST(status AS INTEGER) AS status, place = 0 AS is_first, 'page ' || target AS link,
  CAST(page_rank AS BIGINT) AS page_rank, complete
FROM got JOIN links USING (chain, k) JOIN whole USING (chain),
  LATERAL (SELECT unnest(if(fork, [0, 2], [0])) AS copy)"""

Q["strict_select"] = """SELECT event_id, ts, user_id, event_type AS Activity,
  '''2024-01-30T00:00:00Z''' AS startDateTime, '''2024-01-30T23:59:59Z''' AS endDateTime,
  '2024-01-31' AS ETLImportDate, CAST(NULL AS VARCHAR) AS DeltaValue, 100 AS SequenceNumber
FROM events"""

Q["flatten"] = """SELECT user_id, event_type AS payload_event_type, value AS payload_metrics_value,
  CAST(json_extract(props, '$.k') AS INTEGER) AS payload_metrics_k, event_id AS x_y
FROM events"""

_ACTIVE = "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 0"

Q["active_semi"] = f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN ({_ACTIVE})"

Q["details"] = f"""WITH active AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_custkey IN ({_ACTIVE}))
SELECT l_orderkey AS dataset_id, l_linenumber, l_partkey, l_returnflag, l_tax
FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM active)
UNION ALL SELECT o_orderkey, 0, NULL, o_orderstatus, NULL FROM active"""

Q["keep_nested"] = """SELECT event_id, user_id, event_type, '2024-01-31' AS ETLImportDate FROM events"""

ORACLE = dict(Q)
