"""Literal defects of the reference text and their opt-in repairs."""

import dataclasses

from pyspark.sql import functions as F

from ledgerline import registry
from ledgerline.params import FIXTURE_PARAMS
from ledgerline.sources.tables import Tables


def run(spark, sf, key, fix=()):
    plan, _, v = registry.report(key)
    p = dataclasses.replace(FIXTURE_PARAMS, fix=frozenset(fix))
    return plan(Tables.from_dir(spark, sf, v.name), p, v)


def test_d1_key_trends_member_id_join(spark, sf):
    literal = run(spark, sf, "mt_member_key_trends")
    fixed = run(spark, sf, "mt_member_key_trends", {"D1"})
    # the text joins member ids to member numbers: only ids that are also some member's number find accounts
    found = literal.filter(F.col("total_balance").isNotNull())
    assert 0 < found.count() < fixed.filter(F.col("total_balance").isNotNull()).count()
    assert found.filter(F.col("member_id") != F.col("member_number")).count() == 0
    assert literal.count() == fixed.count()


def test_d2_debit_12m_counts(spark, sf):
    literal = run(spark, sf, "mt_member_transactions").select(
        "member_number", "debit_transactions_12m", "credit_card_transactions_12m")
    assert literal.filter(F.col("debit_transactions_12m") != F.col("credit_card_transactions_12m")).count() == 0
    fixed = run(spark, sf, "mt_member_transactions", {"D2"})
    st_like = fixed.filter(F.col("debit_transactions_12m") != F.col("credit_card_transactions_12m")).count()
    assert st_like > 0


def test_d3_tltc_prefix(spark, sf):
    literal = run(spark, sf, "mt_cards_transactions")
    fixed = run(spark, sf, "mt_cards_transactions", {"D3"})
    other = lambda df: df.filter(F.col("specific_card_type") == "Other").count()
    assert other(literal) > 0 and other(fixed) == 0


def test_d9_st_loans_include_card_types(spark, sf):
    literal = run(spark, sf, "st_products_overview").filter(F.col("table_name_origin") == "account_loan").count()
    fixed = run(spark, sf, "st_products_overview", {"D9"}).filter(
        F.col("table_name_origin") == "account_loan").count()
    assert literal > fixed


def test_d5_unique_member_status_names(spark, sf):
    cols = run(spark, sf, "mt_member_profile").columns
    assert len(cols) == len(set(c.lower() for c in cols)) == 59


def test_d14_opening_balance(spark, sf):
    literal = run(spark, sf, "st_gl_accounts_general").select("GL_ID", "Period_Date", "Historical_Balance",
                                                             "Period_Balance_Change", "Monthly_Net_Activity")
    fixed = run(spark, sf, "st_gl_accounts_general", {"D14"}).select(
        "GL_ID", "Period_Date", F.col("Historical_Balance").alias("fixed_balance"),
        F.col("Period_Balance_Change").alias("fixed_change"))
    j = literal.join(fixed, ["GL_ID", "Period_Date"])
    assert j.count() == literal.count()
    # the opening amount shifts every balance of an account by the same amount; changes are unaffected
    shifts = j.groupBy("GL_ID").agg(F.countDistinct(F.col("fixed_balance") - F.col("Historical_Balance")).alias("n"))
    assert shifts.filter("n > 1").count() == 0
    assert j.filter(F.col("fixed_balance") != F.col("Historical_Balance")).count() > 0
    assert j.filter(~F.col("fixed_change").eqNullSafe(F.col("Period_Balance_Change"))).count() == 0
