"""Near-duplicate documents: MinHash bands, odd sketches, and a check on the full shingle sets.

A document is the set of its distinct word shingles.  Documents of one set
are one class, and only a class's first document goes on.  ``BANDS`` bands of
``BAND_ROWS`` MinHash values name candidates; the same samples are folded
into an odd sketch, a bitmap of parities, so the number of bits in which two
sketches differ estimates how many samples differ.  Candidates whose sketches
say that they are far below the wanted likeness are dropped.  A second,
longer odd sketch folds the full sets themselves: what two sets share cancels,
so its bits count the shingles they differ in, and never more of them than
there are.  It tells a likeness just under the wanted one (documents made from
one template) from a link without the sets; what passes both is checked on the
full sets.

Within a band bucket every document is first compared with the bucket's hub,
the one with the most neighbours over all its buckets.  What that links is
one component and needs no further comparison.  Documents of buckets that
still hold several components are joined exactly by their rarest shingles
(two sets of the wanted likeness must share one among the first of them, in
positions that leave room for the overlap), so a group of thousands of
copies costs thousands of comparisons, not their square, and no link between
components is lost.  Documents of a template that are no links still meet by
the template's shingles: pairs of ids, which the sketches drop before anything
is written or a set is moved.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, map_batches
from ledgerline.llm.components import components

#: At likeness 0.85 a pair shares no band once in 10^8 pairs, at 0.8 once in 10^5.
BANDS, BAND_ROWS = 40, 6
#: Bits of an odd sketch, in 64-bit words.
SKETCH_WORDS = 16
#: Bits of the odd sketch of a full set, in 64-bit words (at most 2^12 bits: the counters take other bits of a shingle).
WHOLE_WORDS = 64
#: Standard errors of the estimate by which a sketch must miss the likeness.
SLACK = 5.0
#: Counters by which shingles are ordered from rare to frequent; more shingles than that share counters.
COUNTERS = 1 << 20
#: Comparisons with one document that one task takes together.
HUB_SPLIT = 512

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_FACTORS = (_mix(np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64) * _ODD) | np.uint64(1))[:, None]


class Shingler:
    """Sorted 64-bit hashes of a text's distinct shingles; words' hashes are remembered."""

    def __init__(self, words: int) -> None:
        self.words, self.known = words, {}

    def __call__(self, text: str | None) -> np.ndarray:
        known, hash64 = self.known, xxhash.xxh3_64_intdigest
        if len(known) > 100_000:
            known.clear()
        words = (text or "").encode().lower().split()  # bytes: ASCII rules
        if not words:
            return np.empty(0, np.uint64)
        h = np.empty(len(words), np.uint64)
        for i, w in enumerate(words):
            v = known.get(w)
            if v is None:
                v = known[w] = hash64(w)
            h[i] = v
        width = min(self.words, len(h))
        acc = np.full(len(h) - width + 1, np.uint64(width))
        for i in range(width):
            acc = _mix(acc + h[i:len(h) - width + 1 + i]) * _ODD
        return np.unique(acc)


def samples(shingles: np.ndarray) -> np.ndarray:
    """MinHash values of a set of shingle hashes."""
    best = np.full(len(_FACTORS), ~np.uint64(0))
    for low in range(0, len(shingles), 1024):
        np.minimum(best, (shingles[low:low + 1024] * _FACTORS).min(axis=1), out=best)
    return best


def band_keys(sample: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    acc = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in sample.reshape(BANDS, BAND_ROWS).T:
        acc = _mix(acc * _ODD + column)
    return acc


def odd_sketch(sample: np.ndarray) -> np.ndarray:
    """Parities of the numbered samples over 64 * SKETCH_WORDS bits."""
    return _parities(_mix(sample + np.arange(1, len(sample) + 1, dtype=np.uint64) * _ODD), 64 * SKETCH_WORDS)


def whole_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parities of all shingles of a set over 64 * WHOLE_WORDS bits."""
    return _parities(shingles, 64 * WHOLE_WORDS)


def _parities(x: np.ndarray, bits: int) -> np.ndarray:
    parity = (np.bincount((x % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(parity, bitorder="little").view("<u8")


def most_differing_bits(likeness: float) -> int:
    """Largest number of differing bits that two sketches of this likeness may show.

    Of k samples d differ, binomially with mean k (1 - J); each flips two of n
    bits, so n (1 - (1 - 2 / n)^2d) / 2 bits differ, with the variance of
    parities of 2d balls in n urns.
    """
    k, n = BANDS * BAND_ROWS, 64 * SKETCH_WORDS
    d = np.arange(k + 1)
    chance = np.array([math.comb(k, i) * (1 - likeness) ** i * likeness ** (k - i) for i in range(k + 1)])
    mean = n * (1 - (1 - 2 / n) ** (2 * d)) / 2
    noise = (n + n * (n - 1) * (1 - 4 / n) ** (2 * d) - n * n * (1 - 2 / n) ** (4 * d)) / 4
    middle = (chance * mean).sum()
    return int(middle + SLACK * (chance * (noise + (mean - middle) ** 2)).sum() ** 0.5)


def _signed(x: np.ndarray) -> list[int]:
    return x.astype("<u8").view("<i8").tolist()


def sketches(docs: DataFrame, shingle_words: int) -> DataFrame:
    """(doc_id, text_hash, n, c1, c2, bands, sketch) of every row; c1 and c2 name the shingle set."""
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        shingle = Shingler(shingle_words)
        for b in batches:
            out: dict[str, list] = {c: [] for c in ("doc_id", "text_hash", "n", "c1", "c2", "bands", "sketch")}
            for doc, own, text in zip(b["doc_id"].to_pylist(), b["text_hash"].to_pylist(), b["text"]):
                s = shingle(text.as_py())
                c = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8").tolist()
                m = samples(s) if len(s) else None
                for name, v in zip(out, (doc, own, len(s), *c, _signed(band_keys(m)) if len(s) else None,
                                         _signed(odd_sketch(m)) if len(s) else None)):
                    out[name].append(v)
            yield out

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"),
                       "doc_id long, text_hash long, n long, c1 long, c2 long, bands array<long>, sketch array<long>", run)


def most_whole_bits(size_sum: Column, ratio: Fraction) -> Column:
    """Largest number of differing bits of the full sets' sketches at this likeness, for two sets of this total size.

    Linked sets differ in at most d = (1 - J) / (1 + J) * (total size)
    shingles.  That many balls set at most d of n bits, and as long sets come
    near n, no more than the parities' mean and SLACK deviations.
    """
    over, under, n = ratio.numerator, ratio.denominator, 64.0 * WHOLE_WORDS
    d = F.floor(size_sum * (under - over) / F.lit(under + over) + F.lit(1e-9))
    once, twice = F.pow(F.lit(1 - 2 / n), d), F.pow(F.lit(1 - 4 / n), d)
    noise = F.greatest((n + n * (n - 1) * twice - n * n * once * once) / 4, F.lit(0.0))
    return F.least(d.cast("double"), n / 2 * (1 - once) + SLACK * F.sqrt(noise))


def _differ(a: Column, b: Column, words: int) -> Column:
    return sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(words)), F.lit(0))


def _near(a: str, b: str, ratio: Fraction) -> Column:
    """Whether neither sketch of the structs ``a`` and ``b`` (n, sketch, whole) rules out the likeness."""
    return ((_differ(F.col(f"{a}.sketch"), F.col(f"{b}.sketch"), SKETCH_WORDS) <= most_differing_bits(float(ratio)))
            & (_differ(F.col(f"{a}.whole"), F.col(f"{b}.whole"), WHOLE_WORDS)
               <= most_whole_bits(F.col(f"{a}.n") + F.col(f"{b}.n"), ratio)))


def _verify(pairs: DataFrame, sets: DataFrame, ratio: Fraction, scratch: Scratch) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are alike enough.

    ``a`` is the document that many others are compared with: its pairs are
    dealt in groups of about HUB_SPLIT, each of which gets the set of ``a``.
    """
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(HUB_SPLIT)).alias("_of"))
    dealt = pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("_of")).alias("part"))
    left = dealt.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    right = (dealt.select("a", "part").distinct()
             .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a"))
    over, under = ratio.numerator, ratio.denominator

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            a_out, b_out, last, sa = [], [], None, None
            for x, y, x_set, y_set in zip(b["a"].to_pylist(), b["b"].to_pylist(), b["sa"], b["sb"]):
                if x != last:
                    last, sa = x, np.frombuffer(x_set.as_py(), "<u8")
                sb = np.frombuffer(y_set.as_py(), "<u8")
                if min(len(sa), len(sb)) * under < over * max(len(sa), len(sb)):
                    continue
                both = len(sa) + len(sb) - len(np.union1d(sa, sb))
                if both * under >= over * (len(sa) + len(sb) - both):
                    a_out.append(x)
                    b_out.append(y)
            yield {"a": a_out, "b": b_out}

    return scratch.keep(map_batches(left.join(right, ["a", "part"]).select("a", "b", "sa", "sb"), "a long, b long", run), "links")


def _sets(docs: DataFrame, heads: DataFrame, shingle_words: int) -> DataFrame:
    """(node, n, sketch, whole, shingles) of ``heads`` (node, _head, _hash, sketch), from the text with the id and hash of each."""
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        shingle = Shingler(shingle_words)
        for b in batches:
            sets = [shingle(t.as_py()) for t in b["text"]]
            yield {"node": b["node"], "n": [len(s) for s in sets], "sketch": b["sketch"],
                   "whole": [_signed(whole_sketch(s)) for s in sets], "shingles": [s.astype("<u8").tobytes() for s in sets]}

    own = docs.select(F.col("doc_id").cast("long").alias("_doc"), "text")
    one = (own.join(heads, (F.col("_doc") == F.col("_head")) & (F.xxhash64("text") == F.col("_hash")))
           .select("node", "text", "sketch").groupBy("node").agg(F.min("text").alias("text"), F.any_value("sketch").alias("sketch")))
    return map_batches(one, "node long, n long, sketch array<long>, whole array<long>, shingles binary", run)


def _classes(some: DataFrame, scratch: Scratch) -> tuple[DataFrame, bool]:
    """(c1, c2, doc_id, node), a row per shingle set, and whether a doc_id is the smallest one of several sets.

    A set's node is the smallest doc_id that holds it, or a hash of id and set
    where that id is the smallest one of several sets.
    """
    first = scratch.keep(some.groupBy("c1", "c2").agg(F.min("doc_id").alias("doc_id")), "classes")
    clash = scratch.keep(first.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_sets")).where(F.col("_sets") > 1), "clash")
    if clash.isEmpty():
        return first.withColumn("node", F.col("doc_id")), False
    node = F.when(F.col("_sets").isNull(), F.col("doc_id")).otherwise(F.xxhash64("doc_id", "c1", "c2"))
    return scratch.keep(first.join(clash, "doc_id", "left").select("c1", "c2", "doc_id", node.alias("node")), "nodes"), True


def _counters(sets: DataFrame) -> np.ndarray:
    """How often the shingles of ``sets`` occur, by COUNTERS counters."""
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        count = np.zeros(COUNTERS, np.int64)
        for b in batches:
            for s in b["shingles"]:
                count += np.bincount((np.frombuffer(s.as_py(), "<u8") >> np.uint64(44)).astype(np.int64), minlength=COUNTERS)
        seen = np.flatnonzero(count)
        yield {"at": pa.array(seen), "n": pa.array(count[seen])}

    total = np.zeros(COUNTERS, np.int64)
    for r in map_batches(sets.select("shingles"), "at long, n long", run).groupBy("at").agg(F.sum("n").alias("n")).toArrow().to_batches():
        total[r.column("at").to_numpy()] = r.column("n").to_numpy()
    return total


def _rare_first(open_sets: DataFrame, counters: np.ndarray, ratio: Fraction) -> DataFrame:
    """(token, pos, size, node, label, outside): the rarest shingles of each set, as many as a link may miss plus one."""
    shared = open_sets.sparkSession.sparkContext.broadcast(counters)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        count = shared.value
        for b in batches:
            for s, node, label, outside in zip(b["shingles"], b["node"].to_pylist(), b["label"].to_pylist(), b["outside"].to_pylist()):
                x = np.frombuffer(s.as_py(), "<u8")
                first = len(x) - math.ceil(ratio * len(x)) + 1
                order = np.lexsort((x, count[(x >> np.uint64(44)).astype(np.int64)]))[:first]
                n = len(order)
                yield {"token": pa.array(x[order].view("<i8")), "pos": pa.array(np.arange(n)), "size": [len(x)] * n,
                       "node": [node] * n, "label": [label] * n, "outside": [outside] * n}

    return map_batches(open_sets.select("shingles", "node", "label", "outside"),
                       "token long, pos int, size int, node long, label long, outside boolean", run)


def _across(open_sets: DataFrame, ratio: Fraction, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of different labels, a outside, that may be linked: exact, by prefix and position.

    The first common shingle, in the order from rare to frequent, leaves at
    most size - position shingles on either side to overlap in.
    """
    rows = scratch.keep(_rare_first(open_sets, _counters(open_sets), ratio), "prefixes")
    a, b = rows.where("outside").alias("a"), rows.alias("b")
    over, both = ratio.numerator, ratio.numerator + ratio.denominator
    overlap = F.floor((F.lit(over) * (F.col("a.size") + F.col("b.size")) + F.lit(both - 1)) / F.lit(both))
    return (a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.label") != F.col("b.label"))
                   & (F.col("a.pos") + overlap <= F.col("a.size")) & (F.col("b.pos") + overlap <= F.col("b.size"))
                   & (~F.col("b.outside") | (F.col("a.node") < F.col("b.node"))))
            .select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct())


def near_duplicates(docs: DataFrame, shingle_words: int = 5, likeness: float = 0.8) -> DataFrame:
    """(doc_id, n_shingles, component_id, text_hash, label) of every row of ``docs``.

    Words are runs of other than ASCII white space, A-Z in lower case; a text
    of fewer words than a shingle is one shingle, one without words has none
    and is linked with nothing.  Documents are linked if intersection size /
    union size >= ``likeness``; component_id is the smallest doc_id reachable.

    Rows that share a doc_id but not a text are documents of their own: they
    are linked by their texts only.  ``label`` names the component also where
    several components have one smallest doc_id, ``text_hash`` (xxhash64 of
    the text) the row's text.

    Nulls: a null text has no words.  A row with a null doc_id is not
    compared (its component_id is null).  Rows not compared have no label.
    An empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    ratio = Fraction(str(likeness))
    signed = scratch.keep(sketches(docs, shingle_words), "sketches")
    some = signed.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    # one node per shingle set; equal sets have equal sketches
    classes, clashing = _classes(some, scratch)
    firsts = (some.join(classes.select("c1", "c2", "node", F.col("doc_id").alias("_first")), ["c1", "c2"])
              .where(F.col("doc_id") == F.col("_first")))
    nodes = scratch.keep(firsts.select("node", F.col("doc_id").alias("_head"), F.col("text_hash").alias("_hash"), "bands", "sketch")
                         .dropDuplicates(["node"]), "nodes")
    member = nodes.select("node", F.explode("bands").alias("band"))
    buckets = scratch.keep(member.groupBy("band").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > 1), "buckets")
    inside = scratch.keep(member.join(buckets, "band").select("band", "node", "k"), "inside")
    near = inside.groupBy("node").agg(F.sum("k").alias("near"))
    hubs = scratch.keep(inside.join(near, "node").groupBy("band").agg(F.max(F.struct("near", (-F.col("node")).alias("node"))).alias("top"))
                        .select("band", (-F.col("top.node")).alias("hub")), "hubs")
    sets = scratch.keep(_sets(docs, nodes.select("node", "_head", "_hash", "sketch").join(near.select("node"), "node"), shingle_words), "sets")

    marks = F.struct("n", "sketch", "whole")

    def like(pairs: DataFrame) -> DataFrame:
        """Pairs whose sketches do not rule out the likeness."""
        return (pairs.join(sets.select(F.col("node").alias("b"), marks.alias("of_b")), "b")
                .join(sets.select(F.col("node").alias("a"), marks.alias("of_a")), "a")
                .where(_near("of_a", "of_b", ratio)).select("a", "b"))

    stars = (inside.join(hubs, "band").where(F.col("hub") != F.col("node"))
             .select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct())
    links = _verify(scratch.keep(like(stars), "stars"), sets, ratio, scratch)

    found = components(links, scratch)
    placed = scratch.keep(inside.join(found, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label")), "placed")
    per = placed.groupBy("band", "label").agg(F.count(F.lit(1)).alias("k"))
    mixed = scratch.keep(per.groupBy("band").agg(F.max(F.struct("k", "label")).alias("top"), F.count(F.lit(1)).alias("parts"))
                         .where(F.col("parts") > 1).select("band", F.col("top.label").alias("largest")), "mixed")
    still = placed.join(mixed, "band").groupBy("node", "label").agg(F.max(F.col("label") != F.col("largest")).alias("outside"))
    pairs = _across(scratch.keep(still.join(sets.select("node", "shingles"), "node"), "open"), ratio, scratch)
    extra = _verify(scratch.keep(like(pairs), "more"), sets, ratio, scratch)

    final = components(links.unionByName(extra), scratch)
    of_class = (classes.join(final, "node", "left")
                .select("c1", "c2", "doc_id", "node", F.coalesce("label", "node").alias("label")))
    smallest = F.col("label")  # a component's smallest node is its smallest doc_id, but for hashed nodes
    if clashing:
        of_class = scratch.keep(of_class, "labelled")
        hashed = of_class.where(F.col("node") != F.col("doc_id")).select("label").distinct()
        least = of_class.join(hashed, "label").groupBy("label").agg(F.min("doc_id").alias("_least"))
        of_class, smallest = of_class.join(least, "label", "left"), F.coalesce("_least", "label")
    of_class = of_class.select("c1", "c2", "label", smallest.alias("component_id"))
    alone = (signed.where((F.col("n") == 0) | F.col("doc_id").isNull())
             .select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "text_hash", F.lit(None).cast("long").alias("label")))
    linked = some.join(of_class, ["c1", "c2"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id", "text_hash", "label")
    return linked.unionByName(alone)
