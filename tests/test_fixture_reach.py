"""The fixture reaches what the reports distinguish (at sf0.01)."""

import pytest
from pyspark.sql import functions as F

from ledgerline import registry

BIG = "/root/testdata/sf0.01"

# Measure columns that are one value on every row: the text makes them so, or the anchor date does.
CONSTANT = {
    "transaction_data_extract_date", "data_extract_date", "Is_Voided", "product_type", "transaction_type",
    "Late_Fees_LYTD", "auto_approved", "is_closed", "processing_officer", "approving_officer", "Record_Version",
    "Created_By_User", "Modified_By_User", "modified_timestamp", "address2", "Open_Date", "Last_Modified", "activity_status",
}
LABELS = {
    ("mt_member_profile", "product_relationship_category"): {"No Products", "Single Product", "Multi Product", "Full Relationship"},
    ("st_member_profile", "product_relationship_category"): {"No Products", "Single Product", "Multi Product", "Full Relationship"},
    ("mt_gl_accounts_general", "Activity_Level"): {"No Activity", "Low Activity", "Medium Activity", "High Activity", "Very High Activity"},
    ("st_gl_accounts_general", "Activity_Level"): {"No Activity", "Low Activity", "Medium Activity", "High Activity", "Very High Activity"},
    ("mt_cards_general", "status"): {"Frozen", "Over Limit", "Closed", "Delinquent", "Active", "Blocked"},
    ("st_gl_dividends", "GL_Account_Category"): {"DIVIDEND_EXPENSE", "MEMBER_DEPOSIT_ACCOUNT", "CERTIFICATE_ACCOUNT",
                                                 "OTHER_DIVIDEND_EXPENSE", "CASH_ACCOUNT", "OTHER_GL_ACCOUNT"},
    ("mt_member_transactions", "transaction_volume_category"): {
        "No Transactions", "Low Volume (≤12/year)", "Medium Volume (13-52/year)", "High Volume (53-156/year)", "Very High Volume (>156/year)"},
}


@pytest.mark.parametrize("key, column", sorted(LABELS))
def test_every_label_occurs(spark, key, column):
    found = {r[0] for r in registry.run(spark, BIG, key).select(column).distinct().collect()}
    assert LABELS[key, column] <= found, LABELS[key, column] - found


@pytest.mark.parametrize("key", ["mt_member_key_trends", "mt_member_account_summary", "mt_member_profile", "mt_member_transactions",
                                 "mt_gl_accounts_general", "st_gl_accruals_certificates", "st_loans_general"])
def test_no_measure_is_constant(spark, key):
    df = registry.run(spark, BIG, key)
    counts = df.agg(*[F.count_distinct(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0"))).alias(c) for c in df.columns]).first()
    constant = {c for c in df.columns if counts[c] < 2} - CONSTANT
    assert not constant
