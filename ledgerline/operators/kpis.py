"""Windowed transaction KPIs.

Every KPI of the member-transaction report is a count, sum, min or max, so
it decomposes: transactions are first aggregated per account (map-side
combine, skew-safe), and the per-account partials are summed per member
after the join to the account table.  The join therefore sees one row per
account, not one per transaction, and a fan-out of the account side (e.g.
duplicate account types) multiplies partials exactly as it would multiply
rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.common import from_cents, to_cents
from ledgerline.operators.calendar import add_months


def kpi_windows(as_of: dt.date) -> dict[str, Column]:
    """Window name -> row condition on ``date_effective`` (lifetime = all rows)."""
    d = F.col("date_effective")
    first = as_of.replace(day=1)
    return {
        "lifetime": F.lit(True),
        "mtd": (d >= F.lit(first)) & (d < F.lit(add_months(first, 1))),
        "30d": d >= F.lit(as_of - dt.timedelta(days=30)),
        "90d": d >= F.lit(as_of - dt.timedelta(days=90)),
        "12m": d >= F.lit(_minus_months(as_of, 12)),
    }


def _minus_months(d: dt.date, n: int) -> dt.date:
    m = d.year * 12 + d.month - 1 - n
    y, mo = m // 12, m % 12 + 1
    import calendar
    return dt.date(y, mo, min(d.day, calendar.monthrange(y, mo)[1]))


def account_partials(tx: DataFrame, keys: list[str], windows: dict[str, Column]) -> DataFrame:
    """Per ``keys`` (tenant, account): partial counts and sums (integer cents)
    for every window."""
    a = to_cents("total_amount")
    ab = F.abs(a)
    aggs = []
    for w, c in windows.items():
        life = w == "lifetime"
        aggs += [
            (F.count(F.lit(1)) if life else F.count_if(c)).alias(f"n_{w}"),
            F.count(F.when(c, ab)).alias(f"nn_{w}"),
            (F.sum(ab) if life else F.sum(F.when(c, ab).otherwise(0))).alias(f"sa_{w}"),
            F.count_if(c & (a < 0)).alias(f"nd_{w}"),
            F.count_if(c & (a > 0)).alias(f"nc_{w}"),
            F.sum(F.when(c & (a < 0), ab).otherwise(0)).alias(f"da_{w}"),
            F.sum(F.when(c & (a > 0), a).otherwise(0)).alias(f"ca_{w}"),
        ]
    aggs += [F.min("date_effective").alias("first_d"), F.max("date_effective").alias("last_d")]
    return tx.groupBy(*keys).agg(*aggs)


def round_avg(total: Column, n: Column, in_cents: bool = False) -> Column:
    """ROUND(total / n, 2) for total >= 0 with half-up rounding in integer
    cents, as a double (identical in every engine).

    Exact while twice the total in cents plus ``n`` stays below 2^53, i.e. up
    to totals of about 45 * 10^12: the division runs on doubles.
    """
    cents = total if in_cents else to_cents(total)
    q = F.floor((cents * 2 + n) / (n * 2))
    return F.when(n > 0, q.cast("double") / 100)


def member_kpis(partials: DataFrame, keys: list[str], windows: list[str], cc_flag: Column,
                debit_12m_from_cc: bool) -> DataFrame:
    """Sum account partials per ``keys`` and derive the report columns."""
    s = {}
    sums = []
    for w in windows:
        for p in ("n", "nn", "sa", "nd", "nc", "da", "ca"):
            sums.append(F.sum(f"{p}_{w}").alias(f"{p}_{w}"))
    sums += [F.sum(F.when(cc_flag, F.col("n_12m")).otherwise(0)).alias("cc_n"),
             F.sum(F.when(cc_flag, F.col("sa_12m")).otherwise(0)).alias("cc_a"),
             F.min("first_d").alias("first_d"), F.max("last_d").alias("last_d")]
    g = partials.groupBy(*keys).agg(*sums)
    cols = []
    for w in windows:
        # Where the average is defined (nn > 0) the ELSE-0 sum equals the sum of
        # the matching non-null amounts, so one sum serves both columns.
        avg_src = F.col(f"sa_{w}")
        debit_n = F.col("cc_n") if (w == "12m" and debit_12m_from_cc) else F.col(f"nd_{w}")
        cols += [F.col(f"n_{w}").alias(f"total_transactions_{w}"),
                 from_cents(f"sa_{w}").alias(f"total_transaction_amount_{w}"),
                 round_avg(avg_src, F.col(f"nn_{w}"), in_cents=True).alias(f"avg_transaction_amount_{w}"),
                 debit_n.alias(f"debit_transactions_{w}"),
                 F.col(f"nc_{w}").alias(f"credit_transactions_{w}"),
                 from_cents(f"da_{w}").alias(f"debit_amount_{w}"),
                 from_cents(f"ca_{w}").alias(f"credit_amount_{w}")]
    cols += [F.col("cc_n").alias("credit_card_transactions_12m"),
             from_cents("cc_a").alias("credit_card_amount_12m")]
    return g.select(*keys, *cols, "first_d", "last_d", "n_30d", "n_90d", "n_12m")
