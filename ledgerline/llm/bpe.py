"""Byte-level BPE by a global shuffle of distinct words, and decoding by the token-byte table.

Pre-tokens are exploded with their positions, but travel packed: documents
are read in blocks, a block holds its distinct words once and, per position,
a word's number in the block.  Only the blocks' word lists are shuffled, by a
hash of the word, so equal words of all blocks meet in one task and are
encoded once; the ids return to their blocks by a second shuffle and are put
in place by position.  (A row per pre-token would need several times the
input on disk.)
"""

from __future__ import annotations

import base64
import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, map_batches

#: Characters after which a block is closed (a longer document makes a longer block).
BLOCK_CHARS = 4_000_000
#: Word buckets per shuffle partition.
SPREAD = 1
#: Words longer than this are merged with a heap instead of a scan.
SCAN = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: base64 bytes and the id on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one pre-token: the adjacent pair of lowest rank is merged first, leftmost on ties."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > SCAN:
        return _merge_long(word, ranks)
    parts = [word[i:i + 1] for i in range(len(word))]
    pairs = [ranks.get(word[i:i + 2]) for i in range(len(word) - 1)]
    while True:
        best, at = None, -1
        for i, r in enumerate(pairs):
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            return [ranks[p] for p in parts]
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at:
            pairs[at - 1] = ranks.get(parts[at - 1] + parts[at])
        if at < len(pairs):
            pairs[at] = ranks.get(parts[at] + parts[at + 1])


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges in n log n: part starts in a linked list, candidate pairs in a heap."""
    n = len(word)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        if 0 <= i and after[i] < n:
            stop = end[after[i]]
            if (r := ranks.get(word[i:stop])) is not None:
                heapq.heappush(heap, (r, i, stop))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or end[j] != stop:
            continue  # one of the two has been merged since
        alive[j], end[i], after[i] = False, stop, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return [ranks[word[i:end[i]]] for i in range(n) if alive[i]]


def _press(*arrays: np.ndarray) -> bytes:
    """Unsigned numbers and bytes in one compressed blob; numbers as byte planes."""
    head = np.array([len(a) * (1 if a.dtype == np.uint8 else 4) for a in arrays], "<u4").tobytes()
    body = b"".join(a.tobytes() if a.dtype == np.uint8 else np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
                    for a in arrays)
    return zstandard.ZstdCompressor(level=3).compress(head + body)


def _unpress(blob: bytes, kinds: str) -> list[np.ndarray]:
    """Arrays of a blob; ``kinds`` has ``n`` for numbers and ``b`` for bytes."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    sizes = data[:4 * len(kinds)].view("<u4").astype(np.int64)
    out, at = [], 4 * len(kinds)
    for kind, size in zip(kinds, sizes):
        part = data[at:at + size]
        out.append(part if kind == "b" else np.ascontiguousarray(part.reshape(4, -1).T).view("<u4").ravel())
        at += size
    return out


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... (count of them) of each item, one after the other."""
    total = int(counts.sum())
    shift = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return shift + np.arange(total)


def _blocks(buckets: int, pattern: str):
    """Map (row, text) batches to blocks."""
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        find = regex.compile(pattern).findall
        first, made = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32, 0
        ids: list = []
        words: list[str] = []
        lens: list[int] = []
        chars = 0

        def close() -> dict:
            coded = pa.array(words, pa.string()).dictionary_encode()
            local = coded.dictionary.cast(pa.binary())
            home = np.array([xxhash.xxh3_64_intdigest(w) % buckets for w in local.to_pylist()], np.int64)
            order = np.lexsort((np.argsort(np.argsort(local.to_numpy(zero_copy_only=False))), home)) if len(home) else home
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            local, home = local.take(pa.array(order)), home[order]
            chunks = []
            for bucket in np.unique(home):
                low, high = np.searchsorted(home, [bucket, bucket + 1])
                own = local.slice(low, high - low).to_pylist()
                chunks.append({"bucket": int(bucket), "words": _press(
                    np.array([len(w) for w in own], np.uint32), np.frombuffer(b"".join(own), np.uint8))})
            codes = place[coded.indices.to_numpy(zero_copy_only=False)] if words else np.zeros(0, np.int64)
            return {"block": [first + made], "ids": [list(ids)], "lens": [list(lens)],
                    "codes": [_press(codes.astype(np.uint32))], "chunks": [chunks]}

        for b in batches:
            for row, text in zip(b["doc_id"], b["text"]):
                got = find(text.as_py() or "")
                ids.append(row.as_py())
                words += got
                lens.append(len(got))
                chars += len(text.as_py() or "")
                if chars >= BLOCK_CHARS:
                    yield close()
                    made, chars = made + 1, 0
                    ids.clear(), words.clear(), lens.clear()
        if ids:
            yield close()

    return run


def _encode_words(ranks) -> object:
    """Map (bucket, block, words) batches, sorted by bucket, to (block, bucket, ids)."""
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        table = ranks.value
        bucket, known = None, {}
        for b in batches:
            for at, block, blob in zip(b["bucket"].to_pylist(), b["block"].to_pylist(), b["words"]):
                if at != bucket:
                    bucket, known = at, {}
                lens, data = _unpress(blob.as_py(), "nb")
                data, start = data.tobytes(), 0
                counts, out = [], []
                for n in lens.tolist():
                    word = data[start:start + n]
                    start += n
                    got = known.get(word)
                    if got is None:
                        got = known[word] = merge_word(word, table)
                    counts.append(len(got))
                    out += got
                yield {"block": [block], "bucket": [at], "got": [_press(np.array(counts, np.uint32), np.array(out, np.uint32))]}

    return run


def _reassemble(batches: Iterator[dict]) -> Iterator[dict]:
    """Blocks with their words' ids back to documents."""
    for b in batches:
        for ids, lens, codes, parts in zip(b["ids"], b["lens"], b["codes"], b["parts"]):
            got = [_unpress(p["got"], "nn") for p in sorted(parts.as_py() or [], key=lambda p: p["bucket"])]
            counts = np.concatenate([g[0] for g in got]).astype(np.int64) if got else np.zeros(0, np.int64)
            tokens = np.concatenate([g[1] for g in got]).astype(np.int32) if got else np.zeros(0, np.int32)
            starts = np.cumsum(counts) - counts
            place = _unpress(codes.as_py(), "n")[0].astype(np.int64)
            words = np.array(lens.as_py(), np.int64)
            names, low, done = ids.as_py(), 0, 0
            edges = np.cumsum(words)
            while done < len(names):  # about a million words at a time
                stop = max(done + 1, int(np.searchsorted(edges, low + 1_000_000, "right")))
                high = int(edges[stop - 1])
                own = place[low:high]
                each = counts[own]
                flat = tokens[ragged(starts[own], each)]
                ends = np.concatenate([[0], np.cumsum(each)])[edges[done:stop] - low]
                yield {"doc_id": names[done:stop],
                       "ids": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))}
                low, done = high, stop


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): token ids of every text, each match of ``pattern`` encoded by itself.

    ``docs`` has doc_id (long) and text; other columns are not read.  One row
    per row, repeated ids included.  Null or empty texts have no ids.  The
    vocabulary is a file of fixed size; it is read once on the driver and
    broadcast.  Tasks hold one block (``BLOCK_CHARS``, or one document) or
    one bucket of distinct words at a time.
    """
    spark = docs.sparkSession
    buckets = SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions"))
    scratch = Scratch(spark, "bpe")
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    name = f"bpe_blocks_{uuid.uuid4().hex}"
    schema = "block long, ids array<long>, lens array<int>, codes binary, chunks array<struct<bucket:int,words:binary>>"
    (map_batches(docs.select("doc_id", "text"), schema, _blocks(buckets, pattern))
     .write.bucketBy(buckets, "block").option("path", scratch.path("blocks")).option("compression", "none").saveAsTable(name))
    blocks = spark.table(name)
    words = (blocks.select("block", F.explode("chunks").alias("c")).select("block", "c.bucket", "c.words")
             .repartition(buckets, "bucket").sortWithinPartitions("bucket"))
    done = map_batches(words, "block long, bucket int, got binary", _encode_words(ranks))
    parts = done.groupBy("block").agg(F.collect_list(F.struct("bucket", "got")).alias("parts"))
    joined = blocks.select("block", "ids", "lens", "codes").join(parts.hint("shuffle_hash"), "block", "left")
    return map_batches(joined.select("ids", "lens", "codes", "parts"), "doc_id long, ids array<int>", _reassemble)


def decode(tokens: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, ids, bytes): the token-byte table joined to every position of ``ids`` and concatenated.

    The table has one row per token of the vocabulary file, a fixed size, and
    is broadcast; null ids give null bytes.
    """
    spark = tokens.sparkSession
    table = sorted((rank, token) for token, rank in read_ranks(ranks_path).items())
    size = table[-1][0] + 1
    lens = np.zeros(size, np.int64)
    for rank, token in table:
        lens[rank] = len(token)
    shared = spark.sparkContext.broadcast((np.cumsum(lens) - lens, lens, np.frombuffer(b"".join(t for _, t in table), np.uint8)))

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        starts, each, data = shared.value
        for b in batches:
            out = []
            for ids in b["ids"]:
                if not ids.is_valid:
                    out.append(None)
                    continue
                own = ids.values.to_numpy()
                out.append(data[ragged(starts[own], each[own])].tobytes())
            yield {"doc_id": b["doc_id"], "ids": b["ids"], "bytes": pa.array(out, pa.binary())}

    return map_batches(tokens.select("doc_id", "ids"), "doc_id long, ids array<int>, bytes binary", run)
