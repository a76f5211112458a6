"""Connected components of an edge table, by smallest label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): label is the smallest node reachable.

    Every round a node takes the smallest label around it and then that
    label's own label, so long chains shorten by half.  Labels only meet in
    minima (combined before the shuffle): a node with very many edges is no
    larger a row than any other.  Rounds end when no label changes; each is a
    written table.
    """
    both = scratch.keep(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                        .where(F.col("a") != F.col("b")).distinct(), "edges")
    labels = scratch.keep(both.groupBy("a").agg(F.min("b").alias("m"))
                          .select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        step = (labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid")))
        to = labels.select(F.col("node").alias("mid"), F.col("label").alias("jump"))
        new = scratch.keep(step.join(to, "mid").select("node", "old", F.least("mid", "jump").alias("label")), "labels")
        changed = not new.where(F.col("old") != F.col("label")).isEmpty()
        scratch.drop(labels)
        labels = new
        if not changed:
            scratch.drop(both)
            return labels.select("node", "label")
