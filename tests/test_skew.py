"""Rows shuffled once for their own figures, copies in chunks, and distinct card counts over awkward ids."""

import collections
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerline import registry
from ledgerline.operators import skew
from ledgerline.oracle.base import Q
from ledgerline.params import FIXTURE_PARAMS
from ledgerline.sources.tables import Tables
from tools.compare import compare
from tools.plan_audit import executed_plan, scans


def numbers(seed, n=400):
    rng = random.Random(seed)
    return [(rng.choice(["a", "a", "b", None]), rng.choice([1, 1, 1, 2, 3, None]), i, rng.choice([True, False])) for i in range(n)]


def test_own_figures_equal_brute_force_and_read_once(spark, tmp_path):
    data = numbers(1)
    spark.createDataFrame(data, "t string, m int, id int, good boolean").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    packed = rows.select("t", "m", F.array(F.struct("id", "good")).alias("_rows"))
    names = spark.createDataFrame([("a", 1, "one"), ("b", 2, "two")], "t string, m int, name string")
    got = skew.with_own_figures(packed, ["t", "m"], [F.col("_rows")],
                                {"n": F.size("_rows"), "g": F.size(F.filter("_rows", lambda r: r["good"]))},
                                lambda sums: sums.join(names, ["t", "m"], "left"))
    assert set(got.columns) == {"t", "m", "id", "good", "n", "g", "name"}
    n, g = collections.Counter((t, m) for t, m, _, _ in data), collections.Counter((t, m) for t, m, _, ok in data if ok)
    want = {i: (None, None, None) if None in (t, m) else (n[t, m], g[t, m], {("a", 1): "one", ("b", 2): "two"}.get((t, m)))
            for t, m, i, _ in data}
    out = got.collect()
    assert len(out) == len(data) and {r["id"]: (r["n"], r["g"], r["name"]) for r in out} == want
    assert executed_plan(got).count("FileScan parquet") == 1


def test_a_hot_key_is_dealt_to_many_partitions(spark):
    packed = spark.range(20_000).select(F.lit(7).alias("m"), F.array(F.struct("id")).alias("_rows"))
    got = skew.with_own_figures(packed, ["m"], [F.col("_rows")], {"n": F.size("_rows")}, lambda sums: sums)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        parts = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert got.where("n = 20000").count() == 20_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert max(parts) <= 20_000 / skew.PARTS * 5 and len(parts) >= 15


@pytest.mark.parametrize("ordered", [True, False])
def test_copies_are_exact_and_ordered(spark, monkeypatch, ordered):
    monkeypatch.setattr(skew, "COPIES", 10)
    times = [None, 0, 1, 2, 9, 10, 11, 20, 21, 105]
    rows = spark.createDataFrame(list(enumerate(times)), "id int, n long")
    got = [r["id"] for r in skew.repeated(rows, F.col("n"), [F.col("id")], [F.col("id").desc()] if ordered else None).collect()]
    assert collections.Counter(got) == {i: max(1, n or 1) for i, n in enumerate(times)}
    assert not ordered or got == sorted(got, reverse=True)


@pytest.mark.parametrize("ordered", [True, False])
def test_ten_million_copies_of_one_row_are_spread(spark, ordered):
    rows = spark.createDataFrame([(1, 10_000_000), (2, 3)], "id int, n long")
    copies = skew.repeated(rows, F.col("n"), [F.col("id")], [F.col("id").asc()] if ordered else None)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = [r["count"] for r in copies.groupBy(F.spark_partition_id()).count().collect()]
        text = executed_plan(copies)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(parts) == 10_000_003 and len(parts) >= 3 and max(parts) < 6_000_000
    # the chunks are shuffled, not the copies: a generator stands above the exchange and one below it
    above, below = text.split("Exchange", 1)
    assert "Generate explode" in above and "Generate explode" in below


def awkward_transactions(spark, sf, tenancy):
    """Transaction ids shared by accounts and members or missing, accounts listed twice, missing accounts and members."""
    t = Tables.from_dir(spark, sf, tenancy)
    frames = {n: t[n] for n in t}
    th = frames["transaction_history"]
    n = F.xxhash64("transaction_history_id")
    frames["transaction_history"] = th.select(*[
        F.when(F.pmod(n, F.lit(7)) == 0, F.lit(11)).when(F.pmod(n, F.lit(11)) == 0, F.lit(None)).otherwise(F.col(c)).alias(c)
        if c == "transaction_history_id" else
        F.when(F.pmod(n, F.lit(5)) == 0, F.lit(None)).when(F.pmod(n, F.lit(3)) == 0, F.lit(4)).otherwise(F.col(c)).alias(c)
        if c == "member_id" else
        F.when(F.pmod(n, F.lit(13)) == 0, F.lit(None)).otherwise(F.col(c)).alias(c) if c == "account_id" else F.col(c)
        for c in th.columns])
    acc = frames["account"]
    frames["account"] = acc.unionByName(acc.where("account_id % 4 = 0"))
    return Tables.from_frames(frames, tenancy)


@pytest.mark.parametrize("key", ["mt_cards_transactions", "st_cards_transactions"])
def test_card_counts_are_exact_where_ids_repeat_or_are_missing(spark, sf, key):
    plan, oracle, v = registry.report(key)
    tabs = awkward_transactions(spark, sf, v.name)
    got = plan(tabs, FIXTURE_PARAMS, v).toArrow()
    con = duckdb.connect()
    for n in tabs:
        con.register(n, tabs[n].toArrow())
    ok, msg = compare(got, con.sql(oracle(Q(v.name, FIXTURE_PARAMS, bind=False))).to_arrow_table())
    assert ok, msg


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    out = {}
    for tenancy in ("mt", "st"):
        root = str(tmp_path_factory.mktemp(f"once_{tenancy}"))
        Tables.from_dir(spark, sf, tenancy).write(root)
        out[tenancy] = Tables.from_parquet(spark, root, tenancy)
    return out


@pytest.mark.parametrize("key", ["mt_products_overview", "st_products_overview", "mt_cards_general", "st_cards_general"])
def test_every_table_is_read_once(stored, key):
    plan, _, v = registry.report(key)
    text = executed_plan(plan(stored[v.name], FIXTURE_PARAMS, v))
    read = scans(text, stored[v.name])
    if not v.mt:  # the name and whether there is one are two scalar subqueries over one small table
        read.pop("credit_union_info", None)
    assert read and set(read.values()) == {1}, read
    assert "ReusedExchange" in text
