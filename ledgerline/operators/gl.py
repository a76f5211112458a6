"""General-ledger dataflow steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.common import MONEY_SUM, from_cents, to_cents


def monthly_gl_activity(gl_history: DataFrame, keys: list[str], cents: bool = False) -> DataFrame:
    """O2: per keys + account + month: lines, debits (negated negative
    amounts), credits, net and gross amount (decimal, or integer cents when
    ``cents`` so later windows stay on longs)."""
    a = F.col("_c")
    g = (gl_history
         .select(*keys, F.col("gl_account_number").cast("string").alias("account_number"),
                 F.trunc("effective_date", "month").alias("period_start"), to_cents("amount").alias("_c"))
         .groupBy(*keys, "account_number", "period_start")
         .agg(F.count(F.lit(1)).alias("monthly_transactions"),
              F.sum(F.when(a < 0, -a).otherwise(0)).alias("monthly_debits"),
              F.sum(F.when(a > 0, a).otherwise(0)).alias("monthly_credits"),
              F.sum(a).alias("monthly_net_activity"),
              F.sum(F.abs(a)).alias("monthly_total_amount")))
    if cents:
        return g
    sums = ("monthly_debits", "monthly_credits", "monthly_net_activity", "monthly_total_amount")
    return g.select(*[from_cents(c).alias(c) if c in sums else c for c in g.columns])


def running_balance(df: DataFrame, keys: list[str], order: str, value: str,
                    out: str = "calculated_balance", change: str = "period_change") -> DataFrame:
    """Cumulative sum of ``value`` per ``keys`` in ``order`` and its change
    against the previous period (null on the first).  Both windows use the
    same partitioning and ordering: one exchange, one sort.  Integer (cents)
    input stays integer; decimal input yields decimal(38,2)."""
    w = Window.partitionBy(*keys).orderBy(order)
    run = F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    is_int = dict(df.dtypes)[value] in ("bigint", "int")
    df = df.withColumn(out, run if is_int else run.cast(MONEY_SUM))
    diff = F.col(out) - F.lag(out, 1).over(w)
    return df.withColumn(change, diff if is_int else diff.cast(MONEY_SUM))


def accrual_monthly(account_types: DataFrame, gl_history: DataFrame, category: str, mt: bool,
                    paid_abs: bool) -> DataFrame:
    """O5 (aggregation half): per tenant and month, paid and accrued GL activity
    of one product category.

    Paid lines post to the category's ``div_int_acct`` GL numbers, accrued
    lines to its ``accrual_acct`` numbers.  Each posted line is tagged with its
    role(s) by one join to the small distinct (tenant, GL number, role) set,
    so the journal is scanned once.  Distinct batch counts come from a first
    aggregate per (month, role, batch) and a second per month, instead of an
    Expand per distinct aggregate; both stages combine map-side.

    GL numbers compare as numbers: without blanks and leading zeros.  MT:
    codes are canonicalized (upper/trim) and a null status counts as posted.
    ST: codes come in comparison form, status 'D' (and null) is dropped.
    """
    from ledgerline.functions.gl import gl_account_canon

    k = ["credit_union"] if mt else []
    cat = F.upper(F.trim("category")) if mt else F.col("category")
    at = account_types.filter(cat == category)
    canon = gl_account_canon

    def pair(c: str, role: str):
        return F.when(F.col(c).isNotNull(), F.struct(canon(c).alias("_gl"), F.lit(role).alias("_role")))

    roles = (at.select(*k, F.explode(F.filter(F.array(pair("div_int_acct", "paid"), pair("accrual_acct", "accrued")),
                                              lambda r: r.isNotNull())).alias("_r"))
             .select(*k, "_r._gl", "_r._role").distinct())
    posted = (F.upper(F.trim(F.coalesce(F.col("status"), F.lit("P")))) == "P") if mt else (F.col("status") != "D")
    lines = (gl_history.filter(posted)
             .select(*k, canon(F.col("gl_account_number").cast("string")).alias("_gl"), "effective_date",
                     "amount", "batch_number")
             .join(roles, k + ["_gl"], "inner"))
    cents = to_cents("amount")
    amt = F.when((F.col("_role") == "paid") & F.lit(paid_abs), F.abs(cents)).otherwise(cents)
    per_batch = (lines.withColumn("_m", F.trunc("effective_date", "month"))
                 .groupBy(*k, "_m", "_role", "batch_number")
                 .agg(F.sum(amt).alias("_s"), F.count(F.lit(1)).alias("_n"),
                      F.min("effective_date").alias("_lo"), F.max("effective_date").alias("_hi")))

    def side(role: str, name: str) -> list:
        r = F.col("_role") == role
        return [F.max(r).alias(f"has_{name}"),
                from_cents(F.sum(F.when(r, F.col("_s")))).alias(f"{name}_sum"),
                F.count(F.when(r, F.col("batch_number"))).alias(f"{name}_batches"),
                F.sum(F.when(r, F.col("_n"))).alias(f"{name}_lines"),
                F.min(F.when(r, F.col("_lo"))).alias(f"{name}_earliest"),
                F.max(F.when(r, F.col("_hi"))).alias(f"{name}_latest")]

    return per_batch.groupBy(*k, "_m").agg(*side("paid", "paid"), *side("accrued", "acc"))
