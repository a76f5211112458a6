"""Sharding by jump consistent hashing, with gapless slots in every shard.

The shard of a row depends on its key and the number of shards alone: no ring
table, and a shard that is appended takes rows only into itself.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerline.llm.common import numbered

#: Multiplier of the 64-bit linear congruential generator of jump hashing (fixed value).
_LCG = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard (0 to ``shards`` - 1) of each 64-bit key.

    Every pass of the loop jumps all keys that are still below ``shards``;
    about ln(shards) passes are needed, whatever the number of keys.
    """
    state = np.asarray(keys).astype(np.uint64, copy=True)
    bucket = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    at = np.zeros(len(state), np.int64)
    while live.size:
        bucket[live] = at
        state[live] = state[live] * _LCG + np.uint64(1)
        at = ((at + 1) * (float(1 << 31) / ((state[live] >> np.uint64(33)).astype(np.float64) + 1))).astype(np.int64)
        go = at < shards
        live, at = live[go], at[go]
    return bucket.astype(np.int32)


def shard_of(*key: Column, shards: int) -> Column:
    """Shard column for a key of one or more columns (nulls: hashed like any other value)."""
    if shards < 1:
        raise ValueError("shards must be at least 1")

    @pandas_udf("int")
    def jump(h: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(h.to_numpy().view(np.uint64), shards))

    return jump(F.xxhash64(*key))


def shard_manifest(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the text's UTF-8 bytes plus 8; ``slot`` numbers the rows of a
    shard from 0 without gaps, in the order of (cell, key, size, crc).  A
    shard is numbered in cells (a hash of the row, as many per shard as
    shuffle partitions), so no task ever holds a shard: rows are counted per
    cell, cells get their offsets, and a row's slot is the offset plus its
    place in the cell.  Rows that are alike in all three columns are one
    counted row until the end, where chunks of their copies are dealt to tasks,
    so a key that repeats in a third of all rows costs no task more than another.

    Nulls: a null key is a key like any other; a null text has no bytes
    (size 8, crc 0).  An empty table gives an empty manifest.  Other columns
    are not read.
    """
    cells = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    alike = (docs.select(F.col(key), (F.octet_length(body).cast("long") + 8).alias("size"),
                         F.crc32(body).alias("text_crc32"))
             .groupBy(key, "size", "text_crc32").agg(F.count(F.lit(1)).alias("_n")))
    dealt = alike.withColumns({
        "shard": shard_of(F.col(key), shards=shards),
        "grown_shard": shard_of(F.col(key), shards=shards + 1),
        "_cell": F.pmod(F.xxhash64(F.lit("cell"), key, "size", "text_crc32"), F.lit(cells)).cast("int"),
    })
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offset = (dealt.groupBy("shard", "_cell").agg(F.sum("_n").alias("_rows"))
              .select("shard", "_cell", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")))
    ahead = (Window.partitionBy("shard", "_cell").orderBy(key, "size", "text_crc32")
             .rowsBetween(Window.unboundedPreceding, -1))
    placed = (dealt.withColumn("_ahead", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
              .join(offset, ["shard", "_cell"])
              .withColumn("_first", F.col("_offset") + F.col("_ahead")))
    placed = placed.select(key, "size", "text_crc32", "shard", "grown_shard", "_first", "_n")
    return numbered(placed, "_n", "_nth").select(
        key, "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("_first") + F.col("_nth")).alias("slot"),
        "grown_shard")
