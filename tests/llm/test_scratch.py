"""Tables that an operator writes on its way."""

import time

from pyspark.sql import functions as F

from ledgerline.llm import common, toxicity
from ledgerline.llm.common import Scratch


def shuffled(spark):
    """Names of the shuffle files on this machine."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def left_over(spark, before):
    """Shuffle files made since ``before``; files go in the background, so a few seconds are given."""
    for _ in range(50):
        if not (found := shuffled(spark) - before):
            break
        time.sleep(0.1)
    return found


def test_a_written_table_leaves_no_shuffle_files(spark):
    setting = spark.conf.get(common.CLEANUP, None)
    before = shuffled(spark)
    rows = spark.range(2000).groupBy((F.col("id") % 100).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    kept = Scratch(spark, "scratch").keep(rows, "rows")
    assert not left_over(spark, before)
    assert spark.conf.get(common.CLEANUP, None) == setting
    # neither the table nor the frame it was written from needs them
    assert kept.groupBy().agg(F.count("k"), F.sum("n")).first() == (100, 2000)
    assert rows.groupBy().agg(F.count("k"), F.sum("n")).first() == (100, 2000)


def test_the_training_rows_of_toxicity_leave_no_shuffle_files(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("a text of number "), "id").alias("text"))
    labels = spark.range(300).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    before = shuffled(spark)
    scratch = Scratch(spark, "toxic")
    rows = toxicity._shared(common.labelled(docs, labels, "toxic"), scratch)
    assert not left_over(spark, before)
    assert rows.count() == 300


def test_a_worker_gets_a_few_megabytes_at_a_time(spark):
    """3,000 rows of 10,000 characters in one task: 30 MB, below the 10,000 rows that a batch may have."""
    old = spark.conf.get(common.BATCH, None)
    rows = spark.range(3000, numPartitions=1).select(F.repeat(F.lit("x"), 10_000).alias("text"))

    def sizes(batches):
        for b in batches:
            yield {"n": [len(b["text"])], "bytes": [b["text"].nbytes]}

    try:
        spark.conf.unset(common.BATCH)
        got = common.map_batches(rows, "n long, bytes long", sizes).collect()
        assert sum(r["n"] for r in got) == 3000
        assert max(r["bytes"] for r in got) <= 1.1 * common.BATCH_BYTES
        spark.conf.set(common.BATCH, "1m")  # a session's smaller number stays
        common.small_batches(spark)
        assert spark.conf.get(common.BATCH) == "1m"
    finally:
        spark.conf.unset(common.BATCH) if old is None else spark.conf.set(common.BATCH, old)
