"""Per-account transaction activity (O9 and its distinct counts)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.common import from_cents, to_cents


def signed_distinct_activity(tx: DataFrame, keys: list[str], id_col: str, amount: str,
                             prefix: str = "") -> DataFrame:
    """Per ``keys``: distinct ids, distinct ids with a positive / negative
    amount, and the sums of credits, |debits| and net.

    Transaction ids may repeat, so the counts are COUNT(DISTINCT ...).  Instead
    of Spark's Expand-based plan (one copy of every row per distinct
    aggregate), rows are first collapsed to one per (keys, id) with a map-side
    partial aggregate, then counted.  A hot key is split across ids in the
    first shuffle and pre-aggregated before the second.
    """
    a = to_cents(amount)
    per_id = (tx.groupBy(*keys, id_col).agg(
        F.max(a > 0).alias("_pos"),
        F.max(a < 0).alias("_neg"),
        F.sum(F.when(a > 0, a).otherwise(0)).alias("_cr"),
        F.sum(F.when(a < 0, F.abs(a)).otherwise(0)).alias("_dr"),
        F.sum(a).alias("_net")))
    has_id = F.col(id_col).isNotNull()
    return per_id.groupBy(*keys).agg(
        F.count(id_col).alias(f"{prefix}Transactions"),
        F.count_if(has_id & F.col("_pos")).alias(f"{prefix}Deposits"),
        F.count_if(has_id & F.col("_neg")).alias(f"{prefix}Withdrawals"),
        from_cents(F.sum("_cr")).alias(f"{prefix}total_credits"),
        from_cents(F.sum("_dr")).alias(f"{prefix}total_debits"),
        from_cents(F.sum("_net")).alias(f"{prefix}net_change_for_month"))


def rollback_balance(monthly: DataFrame, keys: list[str], order: str, net: str,
                     out: str = "net_change_from_this_month_forward") -> DataFrame:
    """Suffix sum of ``net`` from each period to the last one of its key.

    One hash exchange on ``keys`` and one sort; the result stays partitioned
    on ``keys`` for a following join on the same keys.
    """
    w = (Window.partitionBy(*keys).orderBy(order)
         .rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return monthly.withColumn(out, F.sum(net).over(w))
