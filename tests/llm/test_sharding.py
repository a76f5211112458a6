import zlib

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import queries, sharding
from ledgerline.llm.common import numbered
from tests.llm import edges


def jump(key: int, n: int) -> int:
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_is_the_published_one():
    keys = np.random.default_rng(0).integers(0, 2**63, 2000).astype(np.uint64) * np.uint64(2)
    for n in (1, 2, 24, 1000):
        assert sharding.jump_hash(keys, n).tolist() == [jump(int(k), n) for k in keys]


def check(rows, shards):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], shards)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_query(spark, sf):
    rows = queries.op1_sharding(spark, sf).collect()
    texts = {r["doc_id"]: r["text"].encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    check(rows, 24)
    for r in rows:
        assert (r["size"], r["text_crc32"], r["law"]) == (len(texts[r["doc_id"]]) + 8, zlib.crc32(texts[r["doc_id"]]), "key")


def test_awkward_rows_and_a_hot_key(spark):
    df = edges.docs(spark)
    rows = sharding.shard_manifest(df, 3).collect()
    assert len(rows) == len(edges.ROWS)
    check(rows, 3)
    assert {r["size"] for r in rows if r["doc_id"] == 3} == {8}
    assert sharding.shard_manifest(df.limit(0), 3).collect() == []
    hot = spark.range(3000).select(F.when(F.col("id") < 1000, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"))
    rows = sharding.shard_manifest(hot, 5).collect()
    assert len(rows) == 3000 and len({r["shard"] for r in rows if r["doc_id"] == 7}) == 1
    check(rows, 5)


def test_shards_and_slots_do_not_depend_on_the_layout(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    one = sharding.shard_manifest(df.repartition(7, "text"), 24).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, sharding.shard_manifest(df, 24).collect()))


def test_copies_of_a_hot_row_are_dealt_in_chunks(spark):
    n = 10_000_000
    rows = spark.range(100).select("id", F.when(F.col("id") == 7, F.lit(n)).otherwise(F.lit(3)).cast("long").alias("n"))
    made = numbered(rows, "n", "nth")
    per = (made.select(F.spark_partition_id().alias("task"), "id", "nth").groupBy("task")
           .agg(F.count(F.lit(1)).alias("k")).collect())
    assert sum(r["k"] for r in per) == n + 99 * 3
    assert len(per) > 1 and max(r["k"] for r in per) < 2 * n / len(per)
    assert made.groupBy("id").agg(F.count_distinct("nth").alias("d"), F.min("nth").alias("low"), F.max("nth").alias("high"),
                                  F.max("n").alias("n")).where("d != n or low != 0 or high != n - 1").isEmpty()
    few = numbered(rows.where("id < 3"), "n", "nth").select("id", "nth").collect()
    assert sorted(map(tuple, few)) == [(i, j) for i in range(3) for j in range(3)]
