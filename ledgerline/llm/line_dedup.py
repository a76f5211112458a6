"""Line deduplication over levelled sorted runs of line hashes.

A run is a table of line keys first seen by some batch, bucketed and sorted by
the key's 128-bit hash.  A new batch is reduced to its distinct keys, merge
joined with the runs (their buckets need no shuffle), and the keys that no
run holds become a run of level 0.  ``FANOUT`` runs of a level are compacted
into one of the next, so a key is rewritten once per level.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, columns, fresh, map_batches

#: Runs of one level that are merged into one of the next.
FANOUT = 2
#: Stands for a null id, so that it sorts after all others.
NO_ID = (1 << 63) - 1


def line_key(line: bytes) -> bytes:
    """A line without white space at its ends, A-Z in lower case (bytes methods know ASCII only)."""
    return line.strip().lower()


def _hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _long_enough(key: bytes, least: int) -> bool:
    """Whether a key has ``least`` code points (at most four bytes each)."""
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


def line_keys(docs: DataFrame, least: int) -> DataFrame:
    """(doc, h1, h2): the distinct long-enough line keys of each row, hashed to 128 bits."""
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            ids, found = [], []
            for doc, text in zip(b["doc"].to_pylist(), b["text"].to_pylist()):
                keys = {line_key(x) for x in (text or "").encode().split(b"\n")}
                hashes = [_hash(k) for k in keys if _long_enough(k, least)]
                found += hashes
                ids += [doc] * len(hashes)
            h = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
            yield {"doc": ids, "h1": pa.array(h[:, 0]), "h2": pa.array(h[:, 1])}

    slim = docs.select(F.coalesce(F.col("doc_id"), F.lit(NO_ID)).cast("long").alias("doc"), "text")
    return map_batches(slim, "doc long, h1 long, h2 long", run)


class LineRuns:
    """The runs of the line keys seen so far: (h1, h2, keeper), keys disjoint between runs."""

    def __init__(self, spark: SparkSession, scratch: Scratch) -> None:
        self.spark, self.scratch = spark, scratch
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: dict[int, list[str]] = defaultdict(list)

    def _write(self, keys: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        (keys.select("h1", "h2", "keeper").write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
         .option("path", self.scratch.path(name)).option("compression", "zstd").saveAsTable(name))
        self.levels[level].append(name)

    def names(self) -> list[str]:
        return [n for level in sorted(self.levels, reverse=True) for n in self.levels[level]]

    def add(self, keys: DataFrame) -> DataFrame:
        """Take a batch of (doc, h1, h2); return the (h1, h2, keeper) that some document of it must drop.

        The keeper of a key is the smallest document of the first batch that
        has it.  Keys that only their keeper has are not returned.
        """
        own = keys.groupBy("h1", "h2").agg(F.min("doc").alias("_first"), F.max("doc").alias("_last"))
        held = []
        for i, name in enumerate(self.names()):
            run = self.spark.table(name).withColumnRenamed("keeper", f"_held{i}")
            own = own.join(run, ["h1", "h2"], "left")
            held.append(F.col(f"_held{i}"))
        known = F.coalesce(*held, F.lit(None).cast("long"))
        judged = self.scratch.keep(
            own.select("h1", "h2", F.coalesce(known, F.col("_first")).alias("keeper"), "_last", known.isNull().alias("_new")),
            "judged")
        self._write(judged.where("_new"), 0)
        self._compact()
        return judged.where(F.col("_last") != F.col("keeper")).select("h1", "h2", "keeper")

    def _compact(self) -> None:
        level = 0
        while len(self.levels[level]) >= FANOUT:
            old, self.levels[level] = self.levels[level], []
            merged = self.spark.table(old[0])
            for name in old[1:]:
                merged = merged.unionByName(self.spark.table(name))
            self._write(merged.repartition(self.buckets, "h1", "h2"), level + 1)
            self._forget(old)
            level += 1

    def _forget(self, names: list[str]) -> None:
        for name in names:
            files = self.spark.table(name)
            files._written = files.inputFiles()[0].rsplit("/", 1)[0] if files.inputFiles() else None
            self.spark.sql(f"DROP TABLE {name}")
            if files._written:
                self.scratch.drop(files)

    def close(self) -> None:
        for level in list(self.levels):
            self._forget(self.levels.pop(level))


def _rebuild(least: int) -> Column:
    """UDF (text, hashes to drop) -> (n_lines, n_dropped, text)."""
    @F.arrow_udf("struct<n_lines:bigint,n_dropped:bigint,text:string>")
    def rebuild(texts: pa.Array, drops: pa.Array) -> pa.Array:
        lines, dropped, kept = [], [], []
        for text, drop in zip(texts.to_pylist(), drops):
            if not drop.is_valid:
                lines.append((text or "").count("\n") + 1)
                dropped.append(0)
                kept.append(text)
                continue
            pairs = drop.values
            gone = set(zip(pairs.field(0).to_pylist(), pairs.field(1).to_pylist()))
            old = (text or "").encode().split(b"\n")
            new = []
            for x in old:
                k = line_key(x)
                if not _long_enough(k, least) or tuple(np.frombuffer(_hash(k), "<i8").tolist()) not in gone:
                    new.append(x)
            lines.append(len(old))
            dropped.append(len(old) - len(new))
            kept.append(b"\n".join(new).decode())
        return pa.StructArray.from_arrays(
            [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())],
            ["n_lines", "n_dropped", "text"])

    return rebuild


def _same_lines(keys: DataFrame) -> DataFrame:
    """(doc): documents whose long lines are, as a set, those of a smaller document."""
    sets = keys.groupBy("doc").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"))
    first = sets.groupBy("n", "x1", "x2").agg(F.min("doc").alias("first"))
    return sets.join(first, ["n", "x1", "x2"]).where(F.col("doc") > F.col("first")).select("doc")


def dedup_lines(docs: DataFrame, least: int = 10, batches: int = 4, counts: tuple[str, str] = ("_lines", "_dropped"),
                copied: str | None = None) -> DataFrame:
    """Documents without the lines that a smaller doc_id holds.

    Returns the columns of ``docs`` (text: the remaining lines) with the
    ``counts`` columns, the lines before and those dropped.  The
    documents arrive in ``batches`` ranges of ascending doc_id (quantiles over
    all rows), so the first holder of a key is its smallest.

    A key that many documents share is reduced to one row per task before
    the shuffle; the lines to drop are found by a plain equi-join of written
    tables, whose hot keys adaptive execution splits.

    Nulls: a null text is one empty line and stays null; a null doc_id counts
    as one id larger than all others.  Rows that repeat a doc_id are one
    document: none of them loses a line to the other.  An empty table gives
    an empty result.  Other columns pass unchanged (of the given names: replaced).

    ``copied`` names a further column: whether one smaller document holds all
    the lines that a document loses (it keeps them all, or it has the same
    long lines; lines of several documents put together are no copy).
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lines")
    keys = scratch.keep(line_keys(docs, least), "keys")
    cuts = keys.agg(F.percentile_approx("doc", [i / batches for i in range(1, batches)], 10_000)).first()[0] or []
    edges = [None, *sorted(set(cuts)), None]
    runs = LineRuns(spark, scratch)
    judged = None
    for low, high in zip(edges, edges[1:]):
        batch = keys
        if low is not None:
            batch = batch.where(F.col("doc") > low)
        if high is not None:
            batch = batch.where(F.col("doc") <= high)
        lost = batch.join(runs.add(batch), ["h1", "h2"]).where(F.col("doc") != F.col("keeper")).select("doc", "h1", "h2", "keeper")
        judged = lost if judged is None else judged.unionByName(lost)
    runs.close()
    drops = judged.groupBy("doc").agg(F.collect_set(F.struct("h1", "h2")).alias("_drops"),
                                      *([(F.min("keeper") == F.max("keeper")).alias("_one")] if copied else []))
    if copied:
        drops = (drops.join(_same_lines(keys).withColumn("_same", F.lit(True)), "doc", "left")
                 .withColumn("_one", F.col("_one") | F.col("_same").isNotNull()))
    drops = drops.withColumnRenamed("doc", "_doc")
    doc, kept = fresh(docs, "_id"), fresh(docs, "_kept")
    out = (docs.withColumn(doc, F.coalesce(F.col("doc_id"), F.lit(NO_ID)).cast("long"))
           .join(drops.select(F.col("_doc").alias(fresh(docs, "_of")), F.col("_drops").alias(fresh(docs, "_drops")),
                              *([F.col("_one").alias(fresh(docs, "_one"))] if copied else [])),
                 F.col(doc) == F.col(fresh(docs, "_of")), "left")
           .withColumn(kept, _rebuild(least)(F.col("text"), F.col(fresh(docs, "_drops")))))
    own = [F.col(f"{kept}.text").alias("text") if c == "text" else columns(docs.select(F.col(f"`{c}`")))[0]
           for c in docs.columns if c not in (*counts, copied)]
    flag = [F.coalesce(F.col(fresh(docs, "_one")), F.lit(False)).alias(copied)] if copied else []
    return out.select(*own, F.col(f"{kept}.n_lines").alias(counts[0]), F.col(f"{kept}.n_dropped").alias(counts[1]), *flag)
