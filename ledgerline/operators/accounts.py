"""Account-level dataflow steps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def member_account_stats(accounts: DataFrame, keys: list[str], as_of: dt.date, days: int = 90) -> DataFrame:
    """Per (keys, member_number): accounts, closed accounts, accounts
    inactive for more than ``days`` (or never active), and 'True'/'False' for
    more than one account.  Partial aggregation before the shuffle."""
    la = F.col("last_activity")
    g = accounts.groupBy(*keys, "member_number").agg(
        F.count(F.lit(1)).alias("total_accounts_per_member"),
        F.count_if(F.col("date_closed").isNotNull()).alias("deleted_accounts_per_member"),
        F.count_if((la < F.lit(as_of - dt.timedelta(days=days))) | la.isNull()).alias("inactive_accounts_per_member"))
    return g.withColumn("has_multiple_accounts",
                        F.when(F.col("total_accounts_per_member") > 1, "True").otherwise("False"))


def recently_active_accounts(tx: DataFrame, keys: list[str], as_of: dt.date, days: int = 90) -> DataFrame:
    """Distinct (keys, account_id) with a non-void movement on or after
    as_of - ``days``, plus a constant ``_recent`` flag for existence joins."""
    return (tx.filter((F.col("date_actual") >= F.lit(as_of - dt.timedelta(days=days))) & (F.col("void_flag") == 0))
            .select(*keys, "account_id").distinct().withColumn("_recent", F.lit(True)))
