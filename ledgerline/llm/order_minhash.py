"""Document fingerprints by order MinHash: a sketch whose likeness follows the edit distance.

A text is the set of its k-mers, each with its occurrence number.  Each of
``ROWS`` hash functions selects the ``PICK`` k-mers of smallest value; these
keep their text order, and the ordered tuple of their k-mers is hashed to one
row of the signature.  Two texts agree in a row if the same k-mers are
selected in the same order, so moved passages count, not only missing ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_batches

#: Code points per k-mer.
K = 6
#: Hash functions, i.e. rows of a signature.
ROWS = 32
#: K-mers that a row is made of.
PICK = 2
#: K-mers that are hashed at a time.
BLOCK = 1 << 12
#: Stands for a null id, so that it sorts after all others.
NO_ID = (1 << 63) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (xor-shift and odd multiplications)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _multipliers(n: int) -> np.ndarray:
    """Odd factors, one per hash function, as a column."""
    return ((_mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32))
            .astype(np.uint32) | np.uint32(1))[:, None]


def kmer_hashes(text: str) -> np.ndarray:
    """Hash of every k-mer in text order; a text shorter than K is one k-mer, the empty text has none."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(points)
    if n == 0:
        return points
    width = min(K, n)
    h = np.full(n - width + 1, np.uint64(width))
    for i in range(width):
        h = h * np.uint64(0x100000001B3) + points[i:n - width + 1 + i] + np.uint64(1)
    return _mix(h)


def occurrences(h: np.ndarray) -> np.ndarray:
    """How many equal values stand before each one."""
    n = len(h)
    bits = np.uint64(max(1, int(n - 1).bit_length()))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    # the position fills the low bits, so one plain sort groups equal values in text order
    packed = np.sort((h & ~mask) | np.arange(n, dtype=np.uint64))
    place = (packed & mask).astype(np.int64)
    head = np.empty(n, bool)
    head[0] = True
    head[1:] = h[place[1:]] != h[place[:-1]]
    starts = np.flatnonzero(head)
    sizes = np.diff(np.append(starts, n))
    out = np.empty(n, np.uint64)
    out[place] = (np.arange(n) - np.repeat(starts, sizes)).astype(np.uint64)
    return out


def signature(text: str) -> np.ndarray:
    """The text's ROWS row hashes; the empty text has a signature of its own."""
    h = kmer_hashes(text)
    n = len(h)
    if n == 0:
        return np.zeros(ROWS, np.uint64)
    base = (_mix(h + (occurrences(h) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(32)).astype(np.uint32)
    factors, rows = _multipliers(ROWS), np.arange(ROWS)
    best = np.empty((ROWS, 0), np.uint32)
    where = np.empty((ROWS, 0), np.int64)
    for low in range(0, n, BLOCK):  # k-mers at a time, so that the working set stays in cache
        v = base[low:low + BLOCK] * factors
        for _ in range(min(PICK, v.shape[1])):
            i = v.argmin(axis=1)
            best, where = np.column_stack([best, v[rows, i]]), np.column_stack([where, i + low])
            v[rows, i] = ~np.uint32(0)
        if best.shape[1] > PICK:
            keep = np.argsort(best, axis=1, kind="stable")[:, :PICK]
            best, where = np.take_along_axis(best, keep, 1), np.take_along_axis(where, keep, 1)
    where.sort(axis=1)
    acc = (rows + 1).astype(np.uint64)
    for at in where.T:
        acc = _mix(acc * np.uint64(0x9E3779B97F4A7C15) + h[at])
    return acc


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of rows in which two signatures agree."""
    return float(np.count_nonzero(a == b)) / ROWS


def as_text(sig: np.ndarray) -> str:
    """Eight hex digits of every row."""
    return (sig >> np.uint64(32)).astype(">u4").tobytes().hex()


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the first as many code points of ``following``."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def _neighbours(docs: DataFrame, ranges: int) -> DataFrame:
    """Rows (place, look, doc_id, body): sorted within each place, each place ended by the next one's first row.

    Places are ranges of doc_id; all rows with one id share a place.  Every
    text is shuffled once; the first row of each place is sent to the place
    before as well, so the partitions can be read one after the other without
    a window over the whole table.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(NO_ID)).cast("long")
    slim = docs.select(key.alias("_key"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("body"))
    cuts = slim.agg(F.percentile_approx("_key", [i / ranges for i in range(1, ranges)] or [0.5], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    place = F.when(F.lit(not cuts), F.lit(0))
    for_cut = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array(F.lit(0).cast("long"))
    place = place.otherwise(F.size(F.filter(for_cut, lambda c: c < F.col("_key"))))
    rows = slim.withColumn("place", place.cast("int"))
    firsts = rows.groupBy("place").agg(F.min("_key").alias("_key")).orderBy("place").collect()  # one per place
    if not firsts:
        return rows.withColumn("look", F.lit(0))
    before = {first["_key"]: firsts[i - 1]["place"] for i, first in enumerate(firsts)}
    heads = rows.where(F.col("_key").isin([f["_key"] for f in firsts]))
    to = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    # of rows that repeat a first id only the first in order looks ahead
    ahead = (heads.groupBy("_key").agg(F.min("body").alias("body"))
             .select(F.try_element_at(to, F.col("_key")).cast("int").alias("place"), F.lit(1).alias("look"), "_key",
                     F.lit(None).cast("long").alias("doc_id"), "body"))
    own = rows.select("place", F.lit(0).alias("look"), "_key", "doc_id", "body")
    return own.unionByName(ahead)


def fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprint of every text, of its edited text, and both likenesses.

    ``docs`` has doc_id (long) and text; one row per row: doc_id, n_chars,
    edited (the text itself), fingerprint, edited_fingerprint, near_edited,
    near_next.  The next document is the one of the next larger doc_id, after
    the last the first; a table of one row is its own next.  Rows that repeat
    a doc_id follow each other in text order, a null id comes last.  A null
    text is the empty text, whose fingerprint is all zeros.  An empty table
    gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    n = ranges or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (_neighbours(docs, n).repartition(n, "place")
            .sortWithinPartitions("place", "look", "_key", "body").select("place", "look", "doc_id", "body"))
    schema = ("doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        held = None  # the row before, which waits for its next document
        for b in batches:
            out: dict[str, list] = {c: [] for c in ("doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint",
                                                    "near_edited", "near_next")}
            for place, look, doc, text in zip(b["place"].to_pylist(), b["look"].to_pylist(), b["doc_id"].to_pylist(), b["body"]):
                text = text.as_py()
                sig = signature(text)
                if held is not None and held[0] == place:
                    _, was, before, old = held
                    new = edited(before, text)
                    changed = signature(new)
                    for c, v in zip(out, (was, len(before), new, as_text(old), as_text(changed),
                                          likeness(old, changed), likeness(old, sig))):
                        out[c].append(v)
                held = None if look else (place, doc, text, sig)
                if len(out["doc_id"]) >= 1000:
                    yield out
                    out = {c: [] for c in out}
            yield out

    return map_batches(rows, schema, run)
