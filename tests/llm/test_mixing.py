import re

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import mixing, queries
from tests.llm import edges


def targets(sizes: dict, weights=(3, 1, 2), share=1.5, most=2.0) -> dict:
    """Capping and resharing in rounds, as the contract words it."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, open_ = {}, list(order)
    left = share * sum(sizes.values())
    while open_:
        total = sum(w[s] for s in open_)
        got = {s: left * w[s] / total for s in open_}
        over = [s for s in open_ if got[s] > most * sizes[s]]
        if not over:
            return out | got
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ = [s for s in open_ if s not in over]
    return out


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, docs):
    sizes, largest = {}, {}
    for d in docs:
        n = words(d["text"])
        sizes[d["source"]] = sizes.get(d["source"], 0) + n
        largest[d["source"]] = max(largest.get(d["source"], 0), n)
    want, taken = targets(sizes), {s: 0 for s in sizes}
    assert len(rows) == len(docs)
    for r in rows:
        taken[r["source"]] += r["copies"] * r["size"]
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["copies"] <= 2
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5 * largest[s] + 1e-6


def test_targets_sums_and_reruns(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.mix(df).collect()
    check(rows, df.collect())
    again = mixing.mix(df.repartition(5, "text")).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_the_plan_runs_no_python(spark, sf):
    plan = queries.op2_mixing(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_awkward_rows(spark):
    df = edges.docs(spark)
    rows = mixing.mix(df).collect()
    check(rows, df.collect())
    assert mixing.mix(df.limit(0)).collect() == []
    mixed = mixing.apply_mix(df, mixing.mix(df))
    assert mixed.columns == df.columns
    assert sum(words(r["text"]) for r in mixed.collect()) == sum(r["copies"] * r["size"] for r in rows)


def test_one_hot_row_and_many_levels(spark):
    df = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("doc_id"),
        F.concat(F.lit("s"), F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 4).cast("string")).alias("source"),
        F.when(F.col("id") % 3 == 0, F.lit("a b")).otherwise(F.repeat(F.lit("w "), (F.col("id") % 9).cast("int"))).alias("text"))
    rows = mixing.mix(df).collect()
    check(rows, df.collect())


def test_expected_copies_are_kept(spark):
    df = spark.range(300).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("string").alias("source"), F.lit("a b c").alias("text"))
    total = {}
    for seed in range(6):
        for r in mixing.mix(df, share=1.4, seed=seed).collect():
            total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["copies"]
    odd = [n for i, n in total.items() if i % 2]
    assert len(set(odd)) > 1 and sum(odd) == 6 * 120  # what the capped source leaves: 0.8 copies each
