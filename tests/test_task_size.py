"""How much a task of a report reads, whatever the session was set to."""

import dataclasses
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerline import registry
from ledgerline.params import FIXTURE_PARAMS
from ledgerline.session import INITIAL_PARTS, PARTS, apply_report_conf, check_report_conf
from ledgerline.sources.tables import Tables

SESSION = {"spark.sql.shuffle.partitions": "2", INITIAL_PARTS: None, "spark.sql.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m"}


@pytest.fixture
def coarse(spark):
    """A session of two shuffle partitions and the default advisory size."""
    old = {k: spark.conf.get(k, None) for k in SESSION}
    put = lambda k, v: spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    for k, v in SESSION.items():
        put(k, v)
    yield spark
    for k, v in old.items():
        put(k, v)


@pytest.mark.parametrize("key", ["mt_cards_transactions", "st_gl_dividends"])
def test_every_shuffle_has_enough_parts(coarse, sf, key):
    plan = E.queries()[key](coarse, sf)._jdf.queryExecution().executedPlan().toString()
    parts = [int(n) for n in re.findall(r"hashpartitioning\([^\n]*?, (\d+)\), ENSURE", plan)]
    assert parts and min(parts) >= PARTS, parts


def test_a_shuffle_of_more_than_a_task_reads_is_dealt_to_more_tasks(coarse):
    rows = lambda: coarse.range(16_000_000, numPartitions=4).repartition("id").rdd.getNumPartitions()
    assert check_report_conf(coarse)
    assert rows() <= 2
    apply_report_conf(coarse)
    assert not check_report_conf(coarse)
    assert rows() >= 4


def test_a_larger_number_of_the_session_stays(coarse):
    coarse.conf.set("spark.sql.shuffle.partitions", "1000")
    apply_report_conf(coarse)
    assert coarse.conf.get(INITIAL_PARTS) == "1000"


@pytest.mark.parametrize("branch", [3, None])
@pytest.mark.parametrize("key", ["st_gl_dividends", "st_gl_accounts_transactions"])
def test_rows_of_one_branch_are_dealt_to_many_tasks(coarse, sf, key, branch):
    plan, _, v = registry.report(key)
    t = Tables.from_dir(coarse, sf, v.name)
    frames = {n: t[n] for n in t}
    for n in ("transaction_history", "gl_history"):
        some = F.col("batch_number") >= 0 if branch is not None else F.col("batch_number") < 0  # of all rows, or of none; no literal
        frames[n] = frames[n].withColumn("branch_config_id", F.when(some, F.lit(branch or 0).cast("bigint")))
    coarse.conf.set("spark.sql.shuffle.partitions", "32")
    coarse.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = plan(Tables.from_frames(frames, v.name), dataclasses.replace(FIXTURE_PARAMS, ordered=False), v)
        parts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        coarse.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(parts) > 500 and max(parts) < sum(parts) / 5, parts
