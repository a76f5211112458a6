"""A corpus pipeline: toxicity filter, line dedup, near-duplicate removal, source mixing, tokenisation.

Every stage takes (spark, docs, sf_dir) and works on all documents that the
stage before it kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm import bpe, line_dedup, mixing, near_dedup, toxicity
from ledgerline.llm.common import ASCII_SPACE, Scratch, columns, fresh, labelled

#: Documents that score this or more are rejected as toxic.
TOXIC = 0.3
#: Words per shingle, and the likeness from which documents are near duplicates.
SHINGLE, LIKENESS = 5, 0.8
#: Weights of the sources in code point order, the mix's share of all words, and the most copies.
WEIGHTS, SHARE, MOST = [3, 1, 2], 1.5, 2.0
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator, learned from all labels, does not reject.

    Null and empty texts stay; an empty table stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(labelled(docs, labels, "toxic"))
    names = fresh(docs, "_score"), fresh(docs, "_matches")
    return toxicity.score(docs, model, names).where(F.col(names[0]) < TOXIC).select(*columns(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a smaller doc_id holds; n_chars follows the text.

    A document goes where it is left without words and one smaller document
    holds all the lines it lost: it is a copy.  One put together from lines of
    several others stays with what is left of it, as do documents that had no
    words before, and null texts.
    """
    counts, copied = (fresh(docs, "_lines"), fresh(docs, "_dropped")), fresh(docs, "_copied")
    kept = line_dedup.dedup_lines(docs, counts=counts, copied=copied)
    gone = F.col(copied) & (F.btrim("text", F.lit(ASCII_SPACE)) == "")
    kept = kept.where(~F.coalesce(gone, F.lit(False))).select(*columns(docs))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else kept


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of every group of near duplicates.

    Rows that share a doc_id but not a text are documents of their own.  Of
    rows that are near duplicates and share the smallest doc_id one stays.
    Rows without a doc_id, and documents without words, are nobody's
    duplicates and stay.
    """
    found = near_dedup.near_duplicates(docs, SHINGLE, LIKENESS)
    nth, head, own = fresh(docs, "_nth"), fresh(docs, "_head"), fresh(docs, "_own")
    heads = (found.where(F.col("label").isNotNull() & (F.col("doc_id") == F.col("component_id")))
             .groupBy("label", F.col("doc_id").alias(head)).agg(F.min("text_hash").alias(own)).select(head, own))
    compared = F.col("doc_id").isNotNull() & (F.btrim(F.coalesce("text", F.lit("")), F.lit(ASCII_SPACE)) != "")
    rows = Window.partitionBy(head, own).orderBy(F.xxhash64(*columns(docs)))
    named = (docs.where(compared).join(heads, (F.col("doc_id") == F.col(head)) & (F.xxhash64("text") == F.col(own)))
             .withColumn(nth, F.row_number().over(rows)).where(F.col(nth) == 1))
    return named.select(*columns(docs)).unionByName(docs.where(~compared))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (not at all, once or twice)."""
    return mixing.apply_mix(docs, mixing.mix(docs, WEIGHTS, SHARE, MOST))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text): token ids, and the text decoded from them; a null text has none."""
    vocabulary = public_tokenizers.path(VOCABULARY)
    ids = bpe.encode(docs, vocabulary, public_tokenizers.PATTERN)
    return bpe.decode(ids, vocabulary).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                                              F.col("bytes").cast("string").alias("text"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

#: The learned filter, the mix's draws and the tokens cannot be said in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of ``sf_dir``; each but the last is a written table."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
