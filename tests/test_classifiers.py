"""Boundary tests of the Column classifiers on small literal frames."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.functions import cards as C
from ledgerline.functions import gl as G
from ledgerline.functions import loans as L
from ledgerline.functions import members as M
from ledgerline.functions.accounts import account_channel, account_type_description

AS_OF = dt.date(2001, 7, 15)


def values(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_age_group_boundaries(spark):
    got = values(spark, [(a,) for a in (None, -1, 0, 17, 18, 25, 26, 85, 86)], "age int",
                 M.age_group(F.col("age")))
    assert got == ["Unknown", "Unknown", "A. 0-17", "A. 0-17", "B. 18-25", "B. 18-25", "C. 26-35", "H. 76-85",
                   "I. 85+"]
    plain = values(spark, [(17,), (86,)], "age int", M.age_group(F.col("age"), lettered=False))
    assert plain == ["0-17", "85+"]


def test_tenure_boundaries(spark):
    got = values(spark, [(d,) for d in (0, 182, 183, 364, 365, 1094, 1095, 1824, 1825, None)], "d int",
                 M.tenure_category(F.col("d")))
    assert got == ["1. Recent (0-6 months)", "1. Recent (0-6 months)", "2. New (6-12 months)",
                   "2. New (6-12 months)", "3. Established (1-3 years)", "3. Established (1-3 years)",
                   "4. Mature (3-5 years)", "4. Mature (3-5 years)", "5. Veteran (5+ years)", "5. Veteran (5+ years)"]


def test_full_name_rules(spark):
    rows = [("ann", "", "LEE"), ("ann", "[NULL]", "lee"), ("[NULL]", "x", "lee"), (None, None, "lee"),
            ("ann", "mAry", "lee"), ("ann", None, None)]
    got = values(spark, rows, "f string, m string, l string", M.full_name("f", "m", "l"))
    assert got == ["Ann Lee", "Ann Lee", "Lee", "Lee", "Ann Mary Lee", None]


def test_gl_activity_level_and_volume(spark):
    got = values(spark, [(n,) for n in (None, 0, 10, 11, 50, 51, 200, 201)], "n bigint",
                 G.gl_activity_level("n"))
    assert got == ["No Activity", "No Activity", "Low Activity", "Medium Activity", "Medium Activity",
                   "High Activity", "High Activity", "Very High Activity"]
    vol = values(spark, [(n,) for n in (0, 12, 13, 52, 53, 156, 157)], "n bigint",
                 M.transaction_volume_category("n"))
    assert vol == ["No Transactions", "Low Volume (≤12/year)", "Medium Volume (13-52/year)",
                   "Medium Volume (13-52/year)", "High Volume (53-156/year)", "High Volume (53-156/year)",
                   "Very High Volume (>156/year)"]


def test_gl_subcategory_shadowed_ranges(spark):
    # 740-750 with a positive balance is shadowed by 701-799.
    rows = [("B", 745, 1), ("B", 700, 1), ("B", 700, -1), ("B", 995, -1), ("I", 150, 0), ("I", 500, 0),
            ("X", 150, 0)]
    got = values(spark, rows, "t string, n int, b int", G.gl_subcategory("t", F.col("n"), "b"))
    assert got == ["ASSETS - Loans to Members", "OTHER", "CONTRA-ASSETS - Allowances/Provisions",
                   "EQUITY - Capital & Reserves", "INCOME - Interest & Fees", "OTHER", "OTHER"]


def test_gl_number_readings(spark):
    rows = [("701.5",), ("799.5",), ("abc",), (None,)]
    mt = values(spark, rows, "x string", G.gl_int_part("x"))
    st = values(spark, rows, "x string", G.gl_numeric("x"))
    assert mt == [701, 799, None, None]
    assert st == [701.5, 799.5, None, None]


def test_gl_account_canon(spark):
    got = values(spark, [(" 00123.4 ",), ("000",), (None,)], "x string", G.gl_account_canon("x"))
    assert got == ["123.4", "", "0"]


def test_accrual_alert_order(spark):
    rows = [(10, 0), (0, 10), (100, 80), (100, 99), (-5, 0)]
    got = values(spark, rows, "p int, a int",
                 G.accrual_alert(F.col("p"), F.col("a"), F.col("p") - F.col("a"), F.abs(F.col("p"))))
    assert got == ["PAID_WITHOUT_ACCRUAL", "ACCRUED_NOT_PAID", "SIGNIFICANT_VARIANCE", "NORMAL",
                   "SIGNIFICANT_VARIANCE"]


def test_delinquency_brackets(spark):
    npd = [AS_OF - dt.timedelta(days=d) for d in (0, 1, 30, 31, 120, 121)] + [None]
    loans = values(spark, [(d,) for d in npd], "d date", L.delinquency_bracket_loans("d", AS_OF))
    assert loans == ["CURRENT", "1-30 days", "1-30 days", "31-60 days", "91-120 days", "Over 120 days", "CURRENT"]
    cards = values(spark, [(d,) for d in npd], "d date", C.delinquency_bracket_cards("d", AS_OF))
    assert cards == ["Current", "1-30 Days", "1-30 Days", "31-60 Days", "91-120 Days", "120+ Days", "Unknown"]


def test_application_channel_and_flags(spark):
    rows = [(" 105 ",), ("SYS",), ("42",), ("123",), (None,)]
    mt = values(spark, rows, "u string", L.application_channel("u", mt=True))
    assert mt == ["ONLINE", "SYSTEM/AUTOMATED", "IN-BRANCH", "STAFF_ASSISTED", "UNKNOWN"]
    st = values(spark, rows, "u string", L.application_channel("u", mt=False))
    assert st[0] == "STAFF_ASSISTED"  # bare comparison: ' 105 ' is not listed
    flags = values(spark, [("TRUE",), ("t",), ("1",), ("yes",), ("bad",), (None,)], "x string", L.text_true("x"))
    assert flags == [True, True, True, False, False, False]


def test_account_channel_and_description(spark):
    rows = [(True, "PCN"), (False, "88"), (False, "123"), (False, "PCN"), (False, None)]
    got = values(spark, rows, "app boolean, u string", account_channel(F.col("app"), F.col("u")))
    assert got == ["Online Application", "Automated Process", "Staff-Assisted", "Migration", "Unknown"]
    rows = [("S", "HYS"), ("S", "ZZZ"), ("C", "RICD"), ("X", "Q")]
    got = values(spark, rows, "d string, t string",
                 account_type_description(F.col("d"), F.col("t"), F.col("d"), F.col("t")))
    assert got == ["High Yield Savings", "Other Savings", "IRA Certificate", "X-Q"]


def test_paid_installments_clamp(spark):
    opened = AS_OF - dt.timedelta(days=400)
    rows = [(None, opened, 12, 12), (AS_OF, opened, 5, 12), (None, opened, 100, 12), (None, opened, 100, 0),
            (None, None, 10, 12), (None, opened, 0, 12)]
    got = values(spark, rows, "date_closed date, date_opened date, number_of_payments int, payments_per_year int",
                 L.paid_installments(AS_OF))
    assert got == [12, 5, 13, 13, None, None]


def test_card_key_matches_text_id(spark):
    rows = [("DRWD", 1, 5), ("DRWD", 1, None), ("DRWD", None, 5), ("TLT", 1, None), ("TLT", 1, 5), ("TLTC", 2, 7),
            ("TLTC", None, 7), ("DRWD", 1, 6)]
    df = spark.createDataFrame(rows, "pre string, a long, m long")
    tlt = F.col("pre") == "TLT"
    out = df.select(C.unique_card_text(F.col("pre"), "a", "m", tlt).alias("t"),
                    C.unique_card_key(F.col("pre"), "a", "m", tlt).alias("k")).collect()
    assert [r.t is None for r in out] == [r.k is None for r in out]
    texts = [r.t for r in out if r.t is not None]
    keys = [tuple(r.k) for r in out if r.k is not None]
    assert len(set(texts)) == len(set(keys))  # same identity: distinct counts agree
    assert texts[0] == "DEBIT_1_5" and "CREDIT_1" in texts and "ACCOUNT_2" in texts
