"""Divergence of sources by late string materialization.

Tasks count the terms of their documents and write the counts beside the
strings.  Only 64-bit digests of the terms and of the groups are shuffled to
sum the counts.  The smallest and the largest string of a digest differ where
two terms collide; such a digest is split by its strings.  Everything after
works on digests, and the strings come back by a join for the terms that the
report keeps.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.bpe import ragged
from ledgerline.llm.common import Scratch, map_batches

#: Documents of a language that hold a kept term at least, and terms per group in the report.
LEAST, TOP = 3, 200
#: Term occurrences that a task counts at a time, and numbers that it holds while it compares sources.
CHUNK, CELLS = 2_000_000, 2_000_000

#: A term: ASCII letters and everything beyond ASCII.
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def share(count: Column, total: Column) -> Column:
    """1 + floor(10^9 * (count + 1) / total) in whole numbers, three digits at a time (total below 9 * 10^15)."""
    left, out = count + 1, F.lit(0).cast("long")
    for _ in range(3):
        out = out * 1000 + F.call_function("div", left * 1000, total)
        left = (left * 1000) % total
    return out + 1


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


def group_digests(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, Column, Column]:
    """(lang, source, lid, gid) of every group, and the digest columns, with a seed under which none collide."""
    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source"))
    groups = scratch.keep(docs.select(lang.alias("lang"), source.alias("source")).distinct(), "groups")
    for seed in range(100):
        lid, gid = F.xxhash64(F.lit(seed), "lang"), F.xxhash64(F.lit(seed), "lang", "source")
        seen = groups.select("lang", "source", lid.alias("lid"), gid.alias("gid"))
        langs = seen.select("lang", "lid").distinct().groupBy("lid").count().where("count > 1")
        clash = seen.groupBy("gid").count().where("count > 1").select("count").unionAll(langs.select("count"))
        if clash.isEmpty():
            return seen, F.xxhash64(F.lit(seed), lang), F.xxhash64(F.lit(seed), lang, source)
    raise RuntimeError("group digests collide under every seed")


def count_terms(docs: DataFrame, lid: Column, gid: Column, bits: int) -> DataFrame:
    """(lid, gid, h, n, d, term, first): occurrences and documents of a term in a group, once per chunk of a task.

    ``first`` marks one row per term and chunk.
    """
    mask = (1 << bits) - 1

    def count(words: list[str], each: list[int], groups: list[int], langs: list[int]) -> dict:
        coded = pa.array(words, pa.string()).dictionary_encode()
        terms, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        names, group = np.unique(np.array(groups, np.int64), return_inverse=True)
        home = np.empty(len(names), np.int64)
        home[group] = langs
        size = max(1, len(terms))
        doc = np.repeat(np.arange(len(each)), each)
        once, times = np.unique(doc * size + codes, return_counts=True)  # a document's distinct terms
        cell = group[once // size] * size + once % size
        order = np.argsort(cell, kind="stable")
        cells, at = np.unique(cell[order], return_index=True)
        h = np.array([xxhash.xxh3_64_intdigest(t) & mask for t in terms.cast(pa.binary()).to_pylist()], np.uint64).astype(np.int64)
        which = cells % size
        first = np.zeros(len(cells), bool)
        first[np.unique(which, return_index=True)[1]] = True
        n = np.add.reduceat(times[order], at) if len(cells) else times
        return {"lid": home[cells // size], "gid": names[cells // size], "h": h[which] if len(cells) else which, "n": n,
                "d": np.diff(np.append(at, len(cell))), "term": terms.take(pa.array(which)), "first": first}

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        words, each, groups, langs = [], [], [], []
        for b in batches:
            for text, g, lang in zip(b["text"], b["gid"].to_pylist(), b["lid"].to_pylist()):
                got = TERM.findall((text.as_py() or "").encode().lower().decode())  # bytes lower A-Z only
                words += got
                each.append(len(got))
                groups.append(g)
                langs.append(lang)
                if len(words) >= CHUNK:
                    yield count(words, each, groups, langs)
                    words, each, groups, langs = [], [], [], []
        if words:
            yield count(words, each, groups, langs)

    return map_batches(docs.select(lid.alias("lid"), gid.alias("gid"), F.col("text").cast("string").alias("text")),
                       "lid long, gid long, h long, n long, d long, term string, first boolean", run)


def term_cells(counts: DataFrame, names: DataFrame) -> DataFrame:
    """(lid, h, tie, docs, cl, cells): every kept term of a language with its (gid, n) cells.

    ``tie`` is empty but where the digest has several strings (``names``:
    h, lo, hi); there it is the string.  A term has one cell per source of the
    language, so a row is no longer than a row of the report's pairs.
    """
    split = names.where(F.col("lo") != F.col("hi")).select("h")
    # The counts' strings are read only where a digest collides.
    if split.isEmpty():
        keyed = counts.select("lid", "gid", "h", F.lit("").alias("tie"), "n", "d")
    else:
        keyed = (counts.join(split, "h", "left_anti").select("lid", "gid", "h", F.lit("").alias("tie"), "n", "d")
                 .unionAll(counts.join(split, "h", "left_semi").select("lid", "gid", "h", F.col("term").alias("tie"), "n", "d")))
    # Tasks have combined their rows; one shuffle serves both sums.
    return (keyed.repartition("lid", "h").groupBy("lid", "h", "tie", "gid").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
            .groupBy("lid", "h", "tie").agg(F.sum("d").alias("docs"), F.sum("n").alias("cl"),
                                            F.collect_list(F.struct("gid", "n")).alias("cells"))
            .where(F.col("docs") >= LEAST))


def _totals(cells: DataFrame, groups: DataFrame, scratch: Scratch) -> DataFrame:
    """(lang, source, lid, gid, v, ng, nl, held, p0): sums over kept terms of every group, terms or not."""
    langs = cells.groupBy("lid").agg(F.count(F.lit(1)).alias("v"), F.sum("cl").alias("nl"))
    own = (cells.select(F.explode("cells").alias("c")).groupBy("c.gid")
           .agg(F.sum("c.n").alias("ng"), F.count(F.lit(1)).alias("held")))
    zero = F.lit(0).cast("long")
    out = (groups.join(langs, "lid", "left").join(own, "gid", "left")
           .select("lang", "source", "lid", "gid", *[F.coalesce(c, zero).alias(c) for c in ("v", "ng", "nl", "held")]))
    # Without kept terms there is nothing to divide by.
    return scratch.keep(out.withColumn("p0", F.when(F.col("v") > 0, share(zero, F.greatest(F.col("ng") + F.col("v"), F.lit(1))))), "totals")


def _both(cells: DataFrame, totals: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b, fix): over the terms that two sources both have, what divergence differs from that of each alone.

    A task takes the sources of many terms at once: all pairs of a term's
    sources are numbers in blocks of memory, summed per pair of sources before
    they leave the task.
    """
    shares = (cells.select("lid", "h", "tie", F.explode("cells").alias("c")).select("lid", "h", "tie", "c.*")
              .join(totals.select("gid", "v", "ng", "p0"), "gid")
              .select("lid", "h", "tie", F.struct("gid", share(F.col("n"), F.col("ng") + F.col("v")).alias("p"), "p0").alias("c"))
              .groupBy("lid", "h", "tie").agg(F.collect_list("c").alias("c")).where(F.size("c") > 1))

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            c = b["c"]
            flat, edge = c.flatten(), np.append(0, np.cumsum(pc.list_value_length(c).to_numpy(zero_copy_only=False)))
            gid, p, p0 = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            names, code = np.unique(gid, return_inverse=True)
            size = np.diff(edge)
            row = np.repeat(np.arange(len(size)), size)
            pairs = np.cumsum(size[row])  # every cell meets all cells of its term
            low = 0
            while low < len(row):
                high = max(low + 1, int(np.searchsorted(pairs, (pairs[low - 1] if low else 0) + CELLS, "right")))
                left = np.repeat(np.arange(low, high), size[row[low:high]])
                right = ragged(edge[row[low:high]], size[row[low:high]])
                off = left != right
                left, right = left[off], right[off]
                fix = (_divergence(p[left], p[right]) - _divergence(p[left], p0[right])
                       - _divergence(p0[left], p[right]) + _divergence(p0[left], p0[right]))
                key = code[left] * len(names) + code[right]
                order = np.argsort(key, kind="stable")
                keys, at = np.unique(key[order], return_index=True)
                if len(keys):
                    yield {"a": names[keys // len(names)], "b": names[keys % len(names)], "fix": np.add.reduceat(fix[order], at)}
                low = high

    return scratch.keep(map_batches(shares.select("c"), "a long, b long, fix long", run)
                        .groupBy("a", "b").agg(F.sum("fix").alias("fix")), "both")


def pair_values(cells: DataFrame, totals: DataFrame, scratch: Scratch) -> DataFrame:
    """(gid, item, value): for every group and other source of its language, the divergence over all kept terms.

    A term that only one of the two has contributes by its count alone, and
    one that neither has by a constant, so these come from each group's
    histogram of counts.  Only terms that both have are compared one by one.
    """
    hist = (cells.select(F.explode("cells").alias("c")).groupBy("c.gid", "c.n").agg(F.count(F.lit(1)).alias("terms"))
            .join(totals.select("gid", "ng", "v"), "gid")
            .select("gid", "terms", share(F.col("n"), F.col("ng") + F.col("v")).alias("p")))
    one = totals.select("lid", F.col("gid").alias("a"), F.col("p0").alias("pa"), F.col("held").alias("ha"), "v")
    two = totals.select("lid", F.col("gid").alias("b"), F.col("p0").alias("pb"), F.col("held").alias("hb"), F.col("source").alias("item"))
    pairs = scratch.keep(one.join(two, "lid").where(F.col("a") != F.col("b")), "pairs")
    of_a = (pairs.select("a", "b", "pb").join(hist.withColumnRenamed("gid", "a"), "a")
            .select("a", "b", (F.col("terms") * divergence(F.col("p"), F.col("pb"))).alias("x")))
    of_b = (pairs.select("a", "b", "pa").join(hist.withColumnRenamed("gid", "b"), "b")
            .select("a", "b", (F.col("terms") * divergence(F.col("pa"), F.col("p"))).alias("x")))
    alone = of_a.unionAll(of_b).groupBy("a", "b").agg(F.sum("x").alias("alone"))
    zero = F.lit(0).cast("long")
    neither = F.when(F.col("v") > 0, (F.col("v") - F.col("ha") - F.col("hb")) * divergence(F.col("pa"), F.col("pb")))
    return (pairs.join(alone, ["a", "b"], "left").join(_both(cells, totals, scratch), ["a", "b"], "left")
            .select(F.col("a").alias("gid"), "item", (F.coalesce(neither, zero) + F.coalesce("alone", zero)
                                                      + F.coalesce("fix", zero)).alias("value")))


def term_values(cells: DataFrame, totals: DataFrame, names: DataFrame, scratch: Scratch) -> DataFrame:
    """(gid, item, value, rank): each group's ``TOP`` terms above their language's share.

    The value that closes the list is found on digests (a task keeps at most
    ``TOP`` rows of a group before the shuffle); all terms that reach it get
    their strings, which decide ties.
    """
    p, q = share(F.col("c.n"), F.col("ng") + F.col("v")), share(F.col("cl"), F.col("nl") + F.col("v"))
    above = scratch.keep(cells.select("h", "tie", "cl", F.explode("cells").alias("c"), F.col("c.gid").alias("gid"))
                         .join(totals.select("gid", "v", "ng", "nl"), "gid")
                         .select("gid", "h", "tie", p.alias("p"), q.alias("q")).where(F.col("p") > F.col("q"))
                         .select("gid", "h", "tie", divergence(F.col("p"), F.col("q")).alias("value")), "above")
    last = (above.select("gid", "value", F.row_number().over(Window.partitionBy("gid").orderBy(F.desc("value"))).alias("rank"))
            .where(F.col("rank") <= TOP).groupBy("gid").agg(F.min("value").alias("_least")))
    reach = above.join(last, "gid").where(F.col("value") >= F.col("_least")).select("gid", "h", "tie", "value")
    item = F.when(F.col("tie") != "", F.col("tie")).otherwise(F.col("lo"))
    ranked = Window.partitionBy("gid").orderBy(F.desc("value"), "item")
    return (reach.join(names.select("h", "lo"), "h").select("gid", item.alias("item"), "value")
            .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= TOP))


def audit(docs: DataFrame, bits: int = 64) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source of a language differs from the others and from it.

    Part ``pair`` ranks the other sources of the language by the divergence
    summed over all kept terms, part ``term`` the group's most telling terms.
    Kept are terms in at least ``LEAST`` documents of the language; a document
    is a row.  All arithmetic is in whole numbers.

    Null text, lang and source count as empty strings; an empty table gives an
    empty result; other columns are not read.  ``bits`` narrows the digests
    (for tests of the splitting).

    A hot source or language is combined per task before any shuffle.  Pairs
    are as many as the result has; a term's row holds one cell per source.
    """
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "audit")
    groups, lid, gid = group_digests(docs, scratch)
    counts = scratch.keep(count_terms(docs, lid, gid, bits), "counts")
    names = scratch.keep(counts.where("first").groupBy("h").agg(F.min("term").alias("lo"), F.max("term").alias("hi")), "names")
    cells = scratch.keep(term_cells(counts, names), "cells")
    totals = _totals(cells, groups, scratch)
    pairs = pair_values(cells, totals, scratch)
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("gid").orderBy(F.desc("value"), "item")))
    terms = term_values(cells, totals, names, scratch)
    both = (pairs.select("gid", F.lit("pair").alias("part"), "item", "value", "rank")
            .unionByName(terms.select("gid", F.lit("term").alias("part"), "item", "value", "rank")))
    return both.join(totals.select("gid", "lang", "source"), "gid").select("lang", "source", "part", "item", "value", "rank")
