import hashlib
import re

from pyspark.sql import functions as F

from ledgerline.llm import line_dedup, queries
from ledgerline.llm.common import Scratch
from tests.llm import edges

SPACE = r"[\x20\x09-\x0D]+"


def key(line):
    return re.sub(f"^{SPACE}|{SPACE}$", "", line).translate({i: i + 32 for i in range(65, 91)})


def expected(docs):
    top = 2**63 - 1
    hold = {}
    for i, t in docs:
        for k in {key(x) for x in (t or "").split("\n")}:
            hold.setdefault(k, set()).add(top if i is None else i)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or min(hold[key(x)]) == (top if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_query(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = sorted((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in expected(docs))
    assert sorted(map(tuple, queries.op5_line_dedup(spark, sf).collect())) == want
    assert any(d for _, _, d, _ in want)


def test_awkward_rows(spark):
    df = edges.docs(spark)
    got = line_dedup.dedup_lines(df, counts=("n1", "n2"))
    assert got.columns == df.columns + ["n1", "n2"]
    rows = got.collect()
    want = expected([(r[0], r[1]) for r in edges.ROWS])
    order = lambda x: tuple((v is None, str(v)) for v in x)
    assert sorted([(r["doc_id"], r["n1"], r["n2"], r["text"] or "") for r in rows], key=order) == sorted(want, key=order)
    assert {(r["_id"], r["_lines"], r["label"]) for r in rows} == {("id", 9, "label")}
    assert all(r["text"] is None for r in rows if r["doc_id"] == 3)
    assert line_dedup.dedup_lines(df.limit(0)).collect() == []


def test_a_line_of_a_third_of_all_documents(spark):
    df = spark.range(900).select(F.col("id").alias("doc_id"), F.concat(
        F.when(F.col("id") % 3 == 0, F.lit("The line that everybody has\n")).otherwise(""), F.lit("own line number "), F.col("id")).alias("text"))
    rows = line_dedup.dedup_lines(df).collect()
    assert sum(r["_dropped"] for r in rows) == 299
    assert [r["doc_id"] for r in rows if "everybody" in r["text"]] == [0]


def test_runs_are_levelled_and_the_first_batch_keeps_a_key(spark):
    runs = line_dedup.LineRuns(spark, Scratch(spark, "runs"))
    schema = "doc long, h1 long, h2 long"
    for b in range(7):
        lost = runs.add(spark.createDataFrame([(10 * b + 1, 1, 1), (10 * b + 2, b, 5), (10 * b + 3, b, 5)], schema)).collect()
        got = {(r["h1"], r["h2"]): r["keeper"] for r in lost}
        assert got == ({(b, 5): 10 * b + 2} | ({(1, 1): 1} if b else {}))
    assert {level: len(names) for level, names in runs.levels.items() if names} == {0: 1, 1: 1, 2: 1}
    held = [tuple(r) for n in runs.names() for r in spark.table(n).collect()]
    assert len(held) == len(set(held)) == 8
    runs.close()


def test_runs_are_joined_without_a_shuffle(spark):
    runs = line_dedup.LineRuns(spark, Scratch(spark, "runs"))
    runs.add(spark.createDataFrame([(1, 1, 1)], "doc long, h1 long, h2 long"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        own = spark.createDataFrame([(2, 1, 1)], "doc long, h1 long, h2 long").groupBy("h1", "h2").agg(F.min("doc").alias("f"))
        plan = own.join(spark.table(runs.names()[0]), ["h1", "h2"], "left")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        runs.close()
