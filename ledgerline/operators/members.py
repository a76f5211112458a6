"""Member-level account summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Discriminator codes counted per member, with the output column for each.
OPEN_COUNT_CODES = {"S": "share_count", "D": "draft_count", "L": "loan_count", "C": "cert_count"}


def account_summary(account: DataFrame, keys: list[str]) -> DataFrame:
    """O6 + O7 in one pass over ``account``: per (keys, member_number) the
    distinct open accounts (total and per discriminator, compared raw) and the
    latest close date.

    COUNT(DISTINCT account_id) per condition is computed by collapsing to one
    row per (member, account_id) first (spreads a hot member across tasks),
    then counting flags per member (map-side combined).
    """
    openr = F.col("date_closed").isNull()
    d = F.col("discriminator")
    per_acct = account.groupBy(*keys, "member_number", "account_id").agg(
        F.max(openr).alias("_open"),
        *[F.max(openr & (d == code)).alias(f"_o{code}") for code in OPEN_COUNT_CODES],
        F.max("date_closed").alias("_closed"))
    has_id = F.col("account_id").isNotNull()
    return per_acct.groupBy(*keys, "member_number").agg(
        F.count_if(has_id & F.col("_open")).alias("total_account_count"),
        *[F.count_if(has_id & F.col(f"_o{code}")).alias(name) for code, name in OPEN_COUNT_CODES.items()],
        F.max("_closed").alias("latest_account_closure_date"))


def closed_member_keys(member: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, member_number) of member rows with all_accounts_closed = 1, with a
    constant ``_any_all_closed`` flag (a partially aggregated DISTINCT)."""
    return (member.filter((F.col("all_accounts_closed") == 1) & F.col("member_number").isNotNull())
            .select(*keys, "member_number").distinct().withColumn("_any_all_closed", F.lit(True)))


def flag_any_all_closed(member: DataFrame, keys: list[str]) -> DataFrame:
    """O7 helper: ``_any_all_closed`` = some member row with the same (keys,
    member_number) has all_accounts_closed = 1.

    The closed keys are a partially aggregated DISTINCT joined back as an
    existence flag, not a window: a window would put every row of a hot member
    number (a third of all rows, say) into one task, while the join gets
    AQE's skew split.
    """
    closed = closed_member_keys(member, keys)
    return (member.join(closed, keys + ["member_number"], "left")
            .withColumn("_any_all_closed", F.coalesce(F.col("_any_all_closed"), F.lit(False))))
