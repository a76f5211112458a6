"""Correctness on the paths a large cluster takes: no broadcast joins
(sort-merge everywhere) and heavily skewed keys."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerline import registry
from ledgerline.oracle.base import Q
from ledgerline.params import FIXTURE_PARAMS
from ledgerline.sources.tables import Tables
from tools.compare import compare

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def no_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("key", ["mt_gl_accounts_general", "mt_gl_accruals_certificates", "mt_member_transactions",
                                 "mt_member_profile", "mt_cards_transactions", "mt_cards_general",
                                 "mt_accounts_general", "mt_products_overview", "st_products_overview",
                                 "st_gl_accounts_transactions", "mt_loans_general", "mt_member_key_trends"])
def test_sort_merge_joins_only(spark, duck, sf, key, no_broadcast):
    df = E.queries()[key](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    ok, msg = compare(df.toArrow(), duck.sql(E.oracle_sql()[key]).to_arrow_table())
    assert ok, msg


def skewed_tables(spark, sf):
    """MT tables where a third of all transactions hit one account and a third
    of all accounts belong to one member (plus null member numbers)."""
    t = Tables.from_dir(spark, sf, "mt")
    frames = {n: t[n] for n in t}
    hot_acct = t["account"].orderBy("account_id").select("credit_union", "account_id", "member_number").first()
    th = frames["transaction_history"]
    hot = F.col("transaction_history_id") % 3 == 0
    frames["transaction_history"] = th.select(
        *[F.when(hot, F.lit(hot_acct["credit_union"])).otherwise(F.col(c)).alias(c) if c == "credit_union" else
          F.when(hot, F.lit(hot_acct["account_id"])).otherwise(F.col(c)).alias(c) if c == "account_id" else
          F.col(c) for c in th.columns])
    acc = frames["account"]
    hot_m = F.col("account_id") % 3 == 0
    frames["account"] = acc.select(
        *[F.when(hot_m, F.lit(hot_acct["credit_union"])).otherwise(F.col(c)).alias(c) if c == "credit_union" else
          F.when(hot_m, F.lit(hot_acct["member_number"])).when(F.col("account_id") % 7 == 1, F.lit(None))
          .otherwise(F.col(c)).alias(c) if c == "member_number" else F.col(c) for c in acc.columns])
    return Tables.from_frames(frames, "mt")


@pytest.mark.parametrize("key", ["mt_account_transactions", "mt_member_transactions", "mt_member_profile",
                                 "mt_member_key_trends", "mt_accounts_general", "mt_products_overview",
                                 "mt_member_details", "mt_cards_transactions"])
def test_hot_keys(spark, sf, key):
    tabs = skewed_tables(spark, sf)
    plan, oracle, v = registry.report(key)
    got = plan(tabs, FIXTURE_PARAMS, v).toArrow()
    con = duckdb.connect()
    for n in tabs:
        con.register(n, tabs[n].toArrow())
    want = con.sql(oracle(Q("mt", FIXTURE_PARAMS, bind=False))).to_arrow_table()
    ok, msg = compare(got, want)
    assert ok, msg


def fanout_tables(spark, sf):
    """MT tables where account types appear twice per (tenant, type) with
    different credit-card flags, and some members twice: every join that the
    reports expect to be 1:1 fans out."""
    t = Tables.from_dir(spark, sf, "mt")
    frames = {n: t[n] for n in t}
    at = frames["account_types"]
    frames["account_types"] = at.unionByName(at.withColumn("credit_card", F.lit("1")))
    m = frames["member"]
    frames["member"] = m.unionByName(m.filter(F.col("member_id") % 5 == 0))
    return Tables.from_frames(frames, "mt")


@pytest.mark.parametrize("key", ["mt_member_transactions", "mt_member_key_trends", "mt_member_profile",
                                 "mt_loans_general", "mt_products_overview", "mt_member_details"])
def test_join_fan_out(spark, sf, key):
    tabs = fanout_tables(spark, sf)
    plan, oracle, v = registry.report(key)
    got = plan(tabs, FIXTURE_PARAMS, v).toArrow()
    con = duckdb.connect()
    for n in tabs:
        con.register(n, tabs[n].toArrow())
    want = con.sql(oracle(Q("mt", FIXTURE_PARAMS, bind=False))).to_arrow_table()
    ok, msg = compare(got, want)
    assert ok, msg


def test_no_nested_loop_without_broadcast(spark, sf, no_broadcast):
    """Even when no side fits a broadcast, every key plans equi-joins only."""
    bad = []
    for key in registry.queries():
        plan, _, v = registry.report(key)
        text = plan(Tables.from_dir(spark, sf, v.name), FIXTURE_PARAMS, v)._jdf.queryExecution().executedPlan().toString()
        if "NestedLoopJoin" in text or "CartesianProduct" in text:
            bad.append(key)
    assert not bad


# AQE calls a partition skewed from 4 kB on, so that the small tables have one.
SKEW = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16"}


@pytest.mark.parametrize("key", ["mt_accounts_general", "mt_products_overview", "mt_cards_general"])
def test_hot_member_is_split(spark, sf, key, no_broadcast):
    """The join on the member number deals a member's rows to several parts (or splits them)."""
    import dataclasses

    old = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    try:
        plan, _, v = registry.report(key)
        df = plan(skewed_tables(spark, sf), dataclasses.replace(FIXTURE_PARAMS, ordered=False), v)
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    by_member = [ln for ln in text.splitlines() if "Join" in ln and "LeftOuter" in ln and ("member_number" in ln or "member_id" in ln)]
    large = [ln for ln in by_member if "_part" in ln]
    assert large, "the rows join their member without being dealt to parts"


@pytest.mark.parametrize("key", ["mt_gl_accounts_general", "st_gl_accounts_general"])
def test_chart_lists_numbers_twice(spark, sf, key):
    """A number that the chart lists m times has m x m rows per month, its balance runs over all m."""
    plan, oracle, v = registry.report(key)
    t = Tables.from_dir(spark, sf, v.name)
    frames = {n: t[n] for n in t}
    chart = frames["gl_chart_of_accounts"].where(F.pmod(F.xxhash64("account_number"), F.lit(3)) < 2)
    again = chart.where(F.pmod(F.xxhash64("account_number"), F.lit(3)) == 0)
    frames["gl_chart_of_accounts"] = (chart.unionByName(again.withColumn("description", F.lit("listed again")))
                                      .unionByName(again.withColumn("inactive", F.lit(1))
                                                   .where(F.pmod(F.xxhash64("account_number"), F.lit(2)) == 0)))
    tabs = Tables.from_frames(frames, v.name)
    got = plan(tabs, FIXTURE_PARAMS, v).toArrow()
    con = duckdb.connect()
    for n in tabs:
        con.register(n, tabs[n].toArrow())
    want = con.sql(oracle(Q(v.name, FIXTURE_PARAMS, bind=False))).to_arrow_table()
    assert got.num_rows > frames["gl_chart_of_accounts"].count() * 37
    ok, msg = compare(got, want)
    assert ok, msg


def hot_facts(spark, sf):
    """ST tables where a third of the journal lies on one GL account and branch, and a third of the transactions on one member, account and branch."""
    t = Tables.from_dir(spark, sf, "st")
    frames = {n: t[n] for n in t}
    branch = t["branch_config"].orderBy("branch_config_id").first()["branch_config_id"]
    gl = t["gl_chart_of_accounts"].where("account_type = 'B'").orderBy("account_number").first()
    member = t["member"].orderBy("member_id").first()["member_id"]
    account = t["account"].orderBy("account_id").first()["account_id"]

    def heated(df, by, values):
        hot = F.pmod(F.xxhash64(by), F.lit(3)) == 0
        return df.select(*[F.when(hot, F.lit(values[c])).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c)
                           if c in values else F.col(c) for c in df.columns]).repartition(8)  # a partition splits by map tasks

    frames["gl_history"] = heated(frames["gl_history"], "record_number",
                                  {"gl_account_number": gl["account_number"], "branch_config_id": branch})
    frames["transaction_history"] = heated(frames["transaction_history"], "transaction_history_id",
                                           {"member_id": member, "account_id": account, "branch_config_id": branch,
                                            "gl_chart_of_account_id": gl["record_number"]})
    return Tables.from_frames(frames, "st")


@pytest.mark.parametrize("key,hot", [("st_gl_accounts_transactions", ["gl_account_number", "branch_config_id"]),
                                     ("st_gl_dividends", ["member_id", "account_id", "gl_chart_of_account_id", "branch_config_id"])])
def test_every_join_of_a_chain_splits_its_hot_key(spark, sf, key, hot, no_broadcast):
    """Journal and dividend rows join one dimension after the other: each join deals its hot key to several tasks."""
    import dataclasses
    import re

    from tools.plan_audit import executed_plan

    old = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    try:
        plan, oracle, v = registry.report(key)
        tabs = hot_facts(spark, sf)
        text = executed_plan(plan(tabs, dataclasses.replace(FIXTURE_PARAMS, ordered=False), v))
        got = plan(tabs, FIXTURE_PARAMS, v).toArrow()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    joins = [re.sub(r"#\d+L?", "", ln) for ln in text.splitlines() if "SortMergeJoin" in ln]
    for c in hot:
        assert any(f"[{c}" in ln and ("skew=true" in ln or "_part" in ln) for ln in joins), (c, joins)
    con = duckdb.connect()
    for n in tabs:
        con.register(n, tabs[n].toArrow())
    ok, msg = compare(got, con.sql(oracle(Q("st", FIXTURE_PARAMS, bind=False))).to_arrow_table())
    assert ok, msg
