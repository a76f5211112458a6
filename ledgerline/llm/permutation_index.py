"""Approximate nearest neighbours by a permutation index.

Pivots are a bounded sample of the vectors; a vector is represented by its
``NEAREST`` nearest pivots in order.  The vectors are dealt to blocks; in each
block a vector is posted, with the pivot's place in its order, in the inverted
files of all its nearest pivots.  A query goes to every block and opens the
files of its own nearest pivots only: each posting adds what the footrule
distance of the two orders saves by the pivot that they share.  The vectors
with the smallest footrule distance are reranked by the true distance.

The index is written once and shuffled once; blocks have a bounded size and
queries pass by their block one after the other, so no task holds the queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, hash_sample, map_batches

#: Pivots, all taken from a sample of four times as many vectors, and how many represent a vector.
PIVOTS, NEAREST = 512, 64
#: Share of a block that is reranked, and the least number of vectors.
RERANKED, RERANKED_ROWS = 0.15, 40
#: Vectors of a block, on average.
BLOCK = 4096


def usable(df: DataFrame, vector: str, key: str) -> DataFrame:
    """(id, vec): vectors as packed doubles, without null, zero or non-finite ones."""
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            ids, out = [], []
            for i, v in zip(b["id"].to_pylist(), b["vec"]):
                if i is None or not v.is_valid or v.values.null_count or not len(v.values):
                    continue
                x = v.values.to_numpy().astype("<f8")
                if np.isfinite(x).all() and x.any():
                    ids.append(i)
                    out.append(x.tobytes())
            yield {"id": ids, "vec": out}

    return map_batches(df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vec")), "id long, vec binary", run)


def matrix(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), "<f8").reshape(len(blobs), -1 if blobs else 0)


def choose_pivots(vectors: DataFrame, total: int) -> np.ndarray:
    """Up to PIVOTS different vectors of the ``total``, by the hash order of ids and vectors."""
    few = hash_sample(vectors, total, 16 * PIVOTS, ("id", "vec"))
    rows = few.orderBy(F.xxhash64("id", "vec"), "id", "vec").limit(4 * PIVOTS).collect()
    different = list(dict.fromkeys(bytes(r["vec"]) for r in rows))[:PIVOTS]
    return matrix(different)


def nearest_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Up to NEAREST pivots of each vector, nearest first (ties: the smaller pivot number)."""
    d = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * x @ pivots.T
    return np.argsort(d, axis=1, kind="stable")[:, :NEAREST].astype("<i2")


def inverted_files(near: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By pivot: the rows of ``near`` that hold it, and its place in each."""
    by_pivot = np.argsort(near.ravel(), kind="stable")
    posted = near.ravel()[by_pivot]
    cuts = np.flatnonzero(np.diff(posted)) + 1
    rows, places = np.split((by_pivot // near.shape[1]).astype("<i4"), cuts), np.split((by_pivot % near.shape[1]).astype("<i2"), cuts)
    return {int(p): (r, at) for p, r, at in zip(posted[np.r_[0, cuts]], rows, places)}


def saved(files: dict[int, tuple[np.ndarray, np.ndarray]], near: np.ndarray, rows: int) -> np.ndarray:
    """What shared pivots take off the footrule distance between ``near`` and each of the block's rows.

    A pivot that only one of two orders of length n holds counts as if it
    stood in the other's place n; one that both hold counts the difference of
    its places.  So each shared pivot saves 2 n - i - j - |i - j|, and the
    distance of two orders that share none is the same for all rows.
    """
    out, n = np.zeros(rows, np.int32), len(near)
    for i, pivot in enumerate(near.tolist()):
        if pivot in files:
            at, places = files[pivot]
            out[at] += 2 * n - i - places - np.abs(places - i)
    return out


def _index(vectors: DataFrame, pivots: np.ndarray, blocks: int) -> DataFrame:
    """Rows of the index: a block's vectors (pivot -1: ids, vectors), then its files (rows, places)."""
    def build(key: tuple, own: pa.Table) -> pa.Table:
        order = np.argsort(own["id"].to_numpy(), kind="stable")
        ids, x = own["id"].to_numpy()[order], matrix(own["vec"].to_pylist())[order]
        files = inverted_files(nearest_pivots(x, pivots))
        return pa.table({"block": pa.array([key[0].as_py()] * (len(files) + 1), pa.int64()),
                         "pivot": pa.array([-1, *files], pa.int32()),
                         "at": pa.array([ids.astype("<i8").tobytes(), *(r.tobytes() for r, _ in files.values())], pa.binary()),
                         "held": pa.array([x.tobytes(), *(p.tobytes() for _, p in files.values())], pa.binary())})

    dealt = vectors.select("id", "vec", F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)).alias("block"))
    return dealt.groupBy("block").applyInArrow(build, "block long, pivot int, at binary, held binary")


def _closest(ids: np.ndarray, x: np.ndarray, files: dict, repeats: bool, query: int, vector: np.ndarray, near: np.ndarray,
             k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of a block's ``k`` nearest to one query, nearest first."""
    n = len(ids)
    value = saved(files, near, n) * np.int64(n) + np.arange(n - 1, -1, -1)  # ties go to the smaller id
    low, high = np.searchsorted(ids, query, "left"), np.searchsorted(ids, query, "right")
    value[low:high] = -1
    best, others = max(RERANKED_ROWS, k, int(RERANKED * n)), n - (high - low)
    while True:
        rows = np.argpartition(value, n - best)[n - best:] if best < n else np.arange(n)
        rows = rows[value[rows] >= 0]
        d = np.sqrt(((x[rows] - vector) ** 2).sum(axis=1))
        rows, d = (v[np.lexsort((ids[rows], d))] for v in (rows, d))
        if repeats:
            first = np.sort(np.unique(ids[rows], return_index=True)[1])
            rows, d = rows[first], d[first]
        if len(rows) >= min(k, others) or best >= n:
            return ids[rows[:k]], d[:k]
        best = n  # rows of one id fill the best: take them all


def search(df: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest others found, by Euclidean distance.

    Vectors of the most frequent length take part (of equally frequent ones,
    the smallest); others have no distance to them.  Rows with a null id, or
    whose vector is null, empty, zero or holds null or non-finite components
    take no part either.  A row is no neighbour of rows of its own id; an id
    that repeats is one neighbour, at its smallest distance, and asks with all
    its vectors.  Ties go to the smaller id.  An empty table gives an empty
    result; other columns are not read.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "ann")
    different = scratch.keep(usable(df, vector, key).distinct(), "vectors")
    size = F.length("vec")
    usual = different.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
    if usual is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    vectors, total = different.where(size == usual["size"]), usual["n"]
    pivots, blocks = choose_pivots(vectors, total), -(-total // BLOCK)
    index = scratch.keep(_index(vectors, pivots, blocks), "index")

    def order(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            blobs = b["vec"].to_pylist()
            yield {"id": b["id"], "vec": b["vec"], "near": [o.tobytes() for o in nearest_pivots(matrix(blobs), pivots)] if blobs else []}

    asked = map_batches(vectors.withColumnRenamed("id", key).where(is_query).withColumnRenamed(key, "id"), "id long, vec binary, near binary", order)
    met = (index.select("block", "pivot", F.lit(None).cast("long").alias("query"), "at", "held")
           .unionByName(asked.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1).cast("long"))).alias("block"), F.lit(PIVOTS).alias("pivot"),
                                     F.col("id").alias("query"), F.col("near").alias("at"), F.col("vec").alias("held")))
           .repartition(blocks, "block").sortWithinPartitions("block", "pivot"))

    def compare(batches: Iterator[dict]) -> Iterator[dict]:
        files, ids, x, repeats = {}, None, None, False
        for b in batches:
            q_out, id_out, d_out = [], [], []
            for pivot, query, at, held in zip(b["pivot"].to_pylist(), b["query"].to_pylist(), b["at"], b["held"]):
                at, held = at.as_buffer(), held.as_buffer()
                if pivot == -1:
                    ids, files = np.frombuffer(at, "<i8").copy(), {}
                    x, repeats = np.frombuffer(held, "<f8").reshape(len(ids), -1).copy(), bool((ids[1:] == ids[:-1]).any())
                elif query is None:
                    files[pivot] = np.frombuffer(at, "<i4").copy(), np.frombuffer(held, "<i2").copy()
                else:
                    top, d = _closest(ids, x, files, repeats, query, np.frombuffer(held, "<f8"), np.frombuffer(at, "<i2"), k)
                    q_out += [query] * len(top)
                    id_out += top.tolist()
                    d_out += d.tolist()
            yield {"query_id": q_out, "vec_id": id_out, "score": d_out}

    found = map_batches(met, "query_id long, vec_id long, score double", compare)
    one = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")).cast("int")
    return one.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
