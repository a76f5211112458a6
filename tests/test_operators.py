"""Operator rewrites against brute force on small frames with the awkward cases."""

import decimal
import random

from pyspark.sql import functions as F

from ledgerline.functions.common import from_cents, to_cents
from ledgerline.operators.activity import signed_distinct_activity
from ledgerline.operators.kpis import round_avg
from ledgerline.operators.members import OPEN_COUNT_CODES, account_summary
from tools.compare import compare

D = decimal.Decimal


def _tx_rows(n=400, seed=7):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        acct = rnd.choice([1, 2, 3, None])
        tid = rnd.choice([None] + list(range(40)))  # ids repeat, some null
        amt = rnd.choice([None, D("0.00")] + [D(rnd.randint(-5000, 5000)) / 100 for _ in range(3)])
        rows.append((acct, tid, amt))
    return rows


def test_signed_distinct_activity_equals_count_distinct(spark):
    df = spark.createDataFrame(_tx_rows(), "account_id long, transaction_history_id long, total_amount decimal(18,2)")
    got = signed_distinct_activity(df, ["account_id"], "transaction_history_id", "total_amount")
    a, tid = F.col("total_amount"), F.col("transaction_history_id")
    want = df.groupBy("account_id").agg(
        F.count_distinct(tid).alias("Transactions"),
        F.count_distinct(F.when(a > 0, tid)).alias("Deposits"),
        F.count_distinct(F.when(a < 0, tid)).alias("Withdrawals"),
        F.round(F.sum(F.when(a > 0, a).otherwise(0)), 2).cast("decimal(38,2)").alias("total_credits"),
        F.round(F.sum(F.when(a < 0, F.abs(a)).otherwise(0)), 2).cast("decimal(38,2)").alias("total_debits"),
        F.round(F.sum(a), 2).cast("decimal(38,2)").alias("net_change_for_month"))
    ok, msg = compare(got.toArrow(), want.toArrow())
    assert ok, msg


def test_account_summary_equals_count_distinct(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["cu0", "cu1"]), rnd.choice([1, 2, None]), rnd.choice([10, 11, 12, None]),
             rnd.choice(["S", "D", "L", "C", "U", "s"]), rnd.choice([None, None, rnd.randint(0, 9)]))
            for _ in range(300)]
    df = spark.createDataFrame(rows, "credit_union string, member_number long, account_id long, "
                                     "discriminator string, closed int")
    df = df.withColumn("date_closed", F.when(F.col("closed").isNotNull(),
                                             F.date_add(F.lit("2001-01-01").cast("date"), F.col("closed"))))
    got = account_summary(df, ["credit_union"])
    op = F.col("date_closed").isNull()
    want = df.groupBy("credit_union", "member_number").agg(
        F.count_distinct(F.when(op, F.col("account_id"))).alias("total_account_count"),
        *[F.count_distinct(F.when(op & (F.col("discriminator") == c), F.col("account_id"))).alias(n)
          for c, n in OPEN_COUNT_CODES.items()],
        F.max("date_closed").alias("latest_account_closure_date"))
    ok, msg = compare(got.toArrow(), want.toArrow())
    assert ok, msg


def test_cents_round_trip_and_half_up_average(spark):
    vals = [D("-12.35"), D("0.00"), D("0.01"), D("99999999.99"), None]
    df = spark.createDataFrame([(v,) for v in vals], "x decimal(18,2)")
    back = [r[0] for r in df.select(from_cents(to_cents("x"))).collect()]
    assert back == vals
    rows = [(1, 3), (2, 3), (5, 2), (0, 7), (10, 4), (1, 0)]  # cents total, count
    got = [r[0] for r in spark.createDataFrame(rows, "c long, n long").select(
        round_avg(F.col("c"), F.col("n"), in_cents=True)).collect()]
    want = [None if n == 0 else float((D(c) / D(n) / 100).quantize(D("0.01"), rounding=decimal.ROUND_HALF_UP))
            for c, n in rows]
    assert got == want
