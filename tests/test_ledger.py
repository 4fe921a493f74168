import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from martkit.plans import ledger

MONTHS = ledger.MONTH_COLUMNS


def test_closed_period(spark):
    # B1: period 1 of 2023 -> 202212; period 10 -> 202309; unknown year -> NULL.
    cc = spark.createDataFrame([("A", "a", 1, 2023001), ("B", "b", 10, 2023001), ("C", "c", 3, 0)],
                               "company string, name string, period_number_current int, date_fiscal_year_begins int")
    dd = spark.createDataFrame([(2023001, dt.date(2023, 1, 1))], "julian_date int, calendar_date date")
    out = ledger.closed_periods(cc, dd)
    assert rows(out, "company_code", "closedperiod_yearmonthid") == [("A", "202212"), ("B", "202309"), ("C", None)]


def test_closed_flag(spark):
    # B2: period 202305 with closed 202304 / 202305 / NULL -> 0 / 1 / 1.
    df = spark.createDataFrame([(202305, "202304"), (202305, "202305"), (202305, None)], "ym bigint, c string")
    assert [r[0] for r in df.select(ledger.closed_flag("ym", "c")).collect()] == [0, 1, 1]


def test_subsidiary_and_category(spark):
    # 990, 99999955, NULL, 12 -> 0, 1, 1, 1.  B4: 8500x & 4100 -> Revenue; NULL & 4100 / 6100 -> Other / Cost.
    df = spark.createDataFrame([("990", "7000"), ("99999955", "7000"), (None, "4100"), ("12", "7000"),
                                ("8500x", "4100"), (None, "6100")], "sub string, acct string")
    got = df.select(ledger.included_subsidiary(F.col("sub")), ledger.account_category(F.col("sub"), F.col("acct"))).collect()
    assert [tuple(r) for r in got] == [(0, "Cost"), (1, "Revenue"), (1, "Other"), (1, "Cost"), (1, "Revenue"), (1, "Cost")]


def test_ledger_flags(spark):
    # Unit type NULL, ledger JA -> 0.  B9: AA and account 6099 / 60995 / 60 -> 1 / 0 / 0.
    df = spark.createDataFrame([(None, "JA", "6099", "1"), ("P1", "BA", "6099", "1"), ("X", "JA", "1", "1"),
                                ("X", "AA", "6099", "1"), ("X", "AA", "60995", "1"), ("X", "AA", "60", "1"),
                                ("X", "AA", "60", "90093"), ("X", "QU", "1", "1")],
                               "ut string, lt string, acct string, bu string")
    f = ledger.ledger_flags(F.col("lt"), F.col("ut"), F.col("acct"), F.col("bu"), F.lit(7))
    got = df.select(f["is_revised_amount"], f["is_cost_to_date_amt_flag"], f["is_change_unit"]).collect()
    assert [tuple(r) for r in got] == [(0, 0, 0), (1, 0, 0), (1, 0, 0), (0, 1, 0), (0, 0, 0), (0, 0, 0), (0, 1, 0),
                                       (0, 0, 1)]


def test_profit_measures(spark):
    # Revenue -100, cost 120 -> revenue 100, margin -20, percent -0.2, loss 1.
    # Projected -100, actual -40 -> backlog 140.  N3: cost 0 -> percent complete 0.
    df = spark.createDataFrame([(-100.0, 120.0, -100.0, 50.0, -40.0, 30.0), (-100.0, 0.0, 0.0, 0.0, -40.0, 30.0)],
                               "ar double, ac double, er double, ec double, xr double, xc double")
    out = ledger.add_profit_measures(df, "ar", "ac", "er", "ec", "xr", "xc", prefix="p_").collect()
    a, b = out
    assert (a.p_adjusted_projected_final_revenue, a.p_projected_margin, a.p_projected_margin_percent,
            a.p_accrued_loss, a.p_backlog) == (100.0, -20.0, -0.2, 1, 140.0)
    assert (b.p_percent_complete, b.p_earned_margin_percent) == (0.0, 0.0)


def _inputs(spark, profit_rows):
    ab = spark.createDataFrame(
        [("A1", "20", "23", "AA", "g", "t", "C", "BU1", "5100", "12", *[100 * m for m in range(1, 13)], 1000, 2000),
         ("A1", "20", "25", "AA", "g", "t", "C", "BU1", "5100", "12", *[1] * 12, 1, 1)],
        "account_id string, century string, fiscal_year string, ledger_types string, subledger_g_l string, "
        "subledger_type string, company string, business_unit string, object_account string, subsidiary string, "
        + ", ".join(f"{m} bigint" for m in MONTHS) + ", amount_beginning_balance_pye_forward bigint, "
        "amount_original_beginning_budget bigint")
    am = spark.createDataFrame([("A1", 7)], "account_id string, account_level_of_detail int")
    bum = spark.createDataFrame([("BU1", "P1", "ok", "pm")], "business_unit string, business_unit_type string, "
                                "category_code_business_unit_17 string, address_number2 string")
    cc = spark.createDataFrame([("C", "c", 5, 2023001)], "company string, name string, period_number_current int, "
                               "date_fiscal_year_begins int")
    dd = spark.createDataFrame([(2023001, dt.date(2023, 1, 1)), (2023032, dt.date(2023, 2, 1))],
                               "julian_date int, calendar_date date")
    codes = spark.createDataFrame([("09", "LT", "AA", "Actual"), ("H50", "TY", "1", "rt")],
                                  "product_code string, user_defined_codes string, user_defined_code string, description string")
    pr = spark.createDataFrame(profit_rows, "date_effective int, type_of_record string, business_unit string, "
                               + ", ".join(f"{a} bigint" for a in ledger.PROFIT_AMOUNTS)
                               + ", date_updated int, time_last_updated int")
    return ab, am, bum, cc, dd, codes, pr


def test_ledger_fact_fanout_and_year_bound(spark):
    # One ledger month, two record types -> 2 rows; type 0 dropped; year 2025 dropped at run year 2024.
    amounts = [-10000, 5000, -20000, 8000, -30000, 9000, -15000, 4000]
    pr_rows = [(2023032, "1", "BU1", *amounts, 0, 0), (2023032, "2", "BU1", *amounts, 0, 0),
               (2023032, "0", "BU1", *amounts, 0, 0)]
    out = ledger.ledger_fact(*_inputs(spark, pr_rows), run_ts=dt.datetime(2024, 6, 1))
    assert out.columns == ledger.FACT_COLUMNS
    got = out.collect()
    assert len(got) == 13          # 12 months of 2023, February twice; no 2025 rows
    feb = [r for r in got if r.year_month_id == 202302]
    assert len(feb) == 2 and all(r.profit_recognition_adjusted_projected_final_revenue == 300.0 for r in feb)
    r = [r for r in got if r.year_month_id == 202305][0]
    assert (r.latest_closed_period_year_month_id, r.is_latest_closed_period_flag, r.amount_net_posting,
            r.ledger_type_desc, r.category) == ("202304", 0, 5.0, "Actual", "Revenue")
    assert [r for r in got if r.year_month_id == 202304][0].is_latest_closed_period_flag == 1


def test_ledger_fact_unique_profit(spark):
    import pytest
    from pyspark.errors import PySparkException
    amounts = [-10000, 5000, -20000, 8000, -30000, 9000, -15000, 4000]
    once = [(2023032, "1", "BU1", *amounts, 0, 0), (2023001, "2", "BU1", *amounts, 0, 0)]
    run = dt.datetime(2024, 6, 1)
    checked = ledger.ledger_fact(*_inputs(spark, once), run_ts=run, unique_profit=True).collect()
    free = ledger.ledger_fact(*_inputs(spark, once), run_ts=run).collect()
    assert sorted(map(tuple, checked), key=str) == sorted(map(tuple, free), key=str)
    with pytest.raises(PySparkException, match="repeated key 2023032, 1, BU1"):
        ledger.ledger_fact(*_inputs(spark, [*once, once[0]]), run_ts=run, unique_profit=True).collect()


def test_ledger_fact_any_join_gives_the_same_rows(spark):
    amounts = [-10000, 5000, -20000, 8000, -30000, 9000, -15000, 4000]
    ins = _inputs(spark, [(2023032, t, "BU1", *amounts, 0, 0) for t in "123"])
    run = dt.datetime(2024, 6, 1)
    small = ledger.ledger_fact(*ins, run_ts=run).collect()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    try:
        large = ledger.ledger_fact(*ins, run_ts=run)
        assert "Broadcast" not in large._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, small), key=str) == sorted(map(tuple, large.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_balances_are_shuffled_before_the_unpivot(spark):
    """Wide rows meet the profit rows; months without one, of a unit that has others, keep their row."""
    amounts = [-10000, 5000, -20000, 8000, -30000, 9000, -15000, 4000]
    ins = _inputs(spark, [(2023032, "1", "BU1", *amounts, 0, 0), (2023032, "1", "BU1", *amounts, 0, 0)])
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(name, -1)
    try:
        out = ledger.ledger_fact(*ins, run_ts=dt.datetime(2024, 6, 1))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(name)
    assert "Generate explode" in plan[:plan.index("SortMergeJoin")]
    rows = out.filter("business_unit_code = 'BU1'").groupBy("account_id", "year_month_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("profit_recognition_earned_cost").alias("profit"),
        F.count("profit_recognition_accrued_loss").alias("loss")).collect()
    first = ins[6].join(ins[4], F.col("date_effective") == F.col("julian_date")).select(
        F.date_format("calendar_date", "yyyyMM").cast("int")).first()[0]
    assert rows and any(r.year_month_id == first for r in rows) and any(r.year_month_id != first for r in rows)
    for r in rows:
        assert (r.n, r.profit, r.loss) == ((2, 2, 2) if r.year_month_id == first else (1, 0, 1))
