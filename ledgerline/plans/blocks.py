"""The reusable dataflow operators as stand-alone keyed results.

Each function applies one operator of the reports to the multi-tenant
tables, so the operator can be checked (and reused) on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.params import Params
from ledgerline.plans.variant import Variant
from ledgerline.sources.tables import Tables


def gl_monthly_activity(t: Tables, p: Params, v: Variant) -> DataFrame:
    """O2 over the whole journal since ``gl_start``."""
    from ledgerline.operators.gl import monthly_gl_activity
    hist = t["gl_history"].filter(F.col("effective_date") >= F.lit(p.gl_start))
    return monthly_gl_activity(hist, v.keys)


def cert_accrual_months(t: Tables, p: Params, v: Variant) -> DataFrame:
    """O5 aggregation half for certificates: paid and accrued GL activity per
    tenant and month (rows with a month and tenant)."""
    from ledgerline.operators.gl import accrual_monthly
    m = accrual_monthly(t["account_types"], t["gl_history"], "CERT", v.mt, paid_abs=False)
    m = m.filter(F.col("_m").isNotNull())
    for c in v.keys:
        m = m.filter(F.col(c).isNotNull())
    return m.select(*v.keys, F.col("_m").alias("month_start"),
                    F.col("paid_sum").alias("paid_amount"), F.col("paid_batches"),
                    F.coalesce(F.col("paid_lines"), F.lit(0)).alias("paid_lines"),
                    F.col("paid_earliest"), F.col("paid_latest"),
                    F.col("acc_sum").alias("accrued_amount"), F.col("acc_batches").alias("accrued_batches"),
                    F.coalesce(F.col("acc_lines"), F.lit(0)).alias("accrued_lines"),
                    F.col("acc_earliest").alias("accrued_earliest"), F.col("acc_latest").alias("accrued_latest"))


def member_account_summary(t: Tables, p: Params, v: Variant) -> DataFrame:
    """O6 + O7: distinct open accounts per discriminator and latest close date per member."""
    from ledgerline.operators.members import account_summary
    return account_summary(t["account"], v.keys)


def member_account_stats(t: Tables, p: Params, v: Variant) -> DataFrame:
    """O10 over valid members' deposit accounts."""
    from ledgerline.operators.accounts import member_account_stats as stats
    acc = t["account"].filter((F.col("member_number") > 0) & v.norm("discriminator").isin("S", "D", "C", "U"))
    return stats(acc, v.keys, p.as_of, p.recent_days)


def recent_account_activity(t: Tables, p: Params, v: Variant) -> DataFrame:
    """Accounts with a non-void movement in the recent window."""
    from ledgerline.operators.accounts import recently_active_accounts
    return recently_active_accounts(t["transaction_history"], v.keys, p.as_of, p.recent_days).drop("_recent")


def member_card_rank(t: Tables, p: Params, v: Variant) -> DataFrame:
    """Best debit and credit card type per member."""
    from ledgerline.functions.cards import member_card_rank as rank
    return rank(t["eft_card_file"], v.keys)


def card_portfolio(t: Tables, p: Params, v: Variant) -> DataFrame:
    """O12 + O13: card portfolio per member over physical cards and credit lines."""
    from ledgerline.functions.cards import card_portfolio as portfolio
    from ledgerline.plans.cards import unified_cards
    return portfolio(unified_cards(t, p, v), v.keys)


def member_product_counts(t: Tables, p: Params, v: Variant) -> DataFrame:
    """Active products per member over the five product sources."""
    from ledgerline.plans.products import product_rows
    rows = product_rows(t, p, v)
    return (rows.filter(F.col("_counts")).groupBy(*v.keys, "member_number")
            .agg(F.count(F.lit(1)).alias("number_of_products_for_member")))


def member_status_dim(t: Tables, p: Params, v: Variant) -> DataFrame:
    """Status, validity, flag and kind labels per member row."""
    from ledgerline.functions import members as M
    from ledgerline.functions.products import member_category
    fc = M.member_filter_columns()
    return t["member"].select(*v.keys, "member_number", M.member_status_strict().alias("member_status"),
                              *[c.alias(n) for n, c in fc.items()],
                              member_category("member_type").alias("member_category"))
