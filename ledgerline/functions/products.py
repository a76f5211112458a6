"""Product-overview classifiers (C26, C39, member kind)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.common import case_map, col

# Product labels of the overview.
ACCOUNT_PRODUCT = {"S": "Savings Account", "D": "Checking Account", "C": "Certificate Account", "U": "Other Account"}
DEBIT_CARD_PRODUCT = {"D": "Debit Card", "DI": "Debit Instant Card", "A": "ATM Card"}
CREDIT_CARD_PRODUCT = {"C": "Credit Gold Card", "PC": "Credit Platinum Card"}
MEMBER_CATEGORY = {"B": "Business", "C": "Corporate", "P": "Member"}
# Card reject codes that disqualify a card as an active product.
BAD_REJECT_CODES = ["34", "36", "41", "43", "07"]
DEBIT_TYPES = ["D", "DI", "A"]
CREDIT_TYPES = ["C", "PC"]
LOAN_CARD_TYPES = ["CC", "PCO", "PCCO"]


def account_product(disc: Column) -> Column:
    return case_map(disc, ACCOUNT_PRODUCT)


def debit_card_product(card_type: Column) -> Column:
    return case_map(card_type, DEBIT_CARD_PRODUCT, "Other Debit Card")


def credit_card_product(card_type: Column) -> Column:
    return case_map(card_type, CREDIT_CARD_PRODUCT, "Other Credit Card")


def member_category(member_type) -> Column:
    return case_map(col(member_type), MEMBER_CATEGORY, "Unknown")


def card_closed_date(as_of: dt.date) -> Column:
    """Block date, else the expiry date once passed, else null."""
    return (F.when(F.col("block_date").isNotNull(), F.col("block_date"))
            .when(F.col("expire_date") < F.lit(as_of), F.col("expire_date")))


def card_counts_as_product(as_of: dt.date, reject: Column) -> Column:
    """O16 card condition: unblocked, unexpired, reject code not disqualifying
    (a null code drops the card), lost flag exactly one blank, PIN used."""
    return (F.col("block_date").isNull() & (F.col("expire_date") >= F.lit(as_of))
            & ~reject.isin(*BAD_REJECT_CODES) & (F.col("lost_or_stolen").cast("string") == " ")
            & F.col("last_pin_used_date").isNotNull())


def card_is_active(as_of: dt.date, reject: Column) -> Column:
    """Row-level active flag of a card (requires reject code '00')."""
    ok = (F.col("block_date").isNull() & (F.col("expire_date") >= F.lit(as_of)) & (reject == "00")
          & (F.col("lost_or_stolen").cast("string") == " ") & F.col("last_pin_used_date").isNotNull())
    return F.when(ok, "Active").otherwise("Inactive")


def recent_label(flag: Column) -> Column:
    return F.when(flag, "With Recent Activity").otherwise("No Recent Activity")
