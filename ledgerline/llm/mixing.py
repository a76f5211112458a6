"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

Every document of a source should be taken ``target / source size`` times.
The whole part is sure; the fractional parts are rounded in pairs: mass (in
words) moves at random from one document of the pair to the other until one
of them is taken wholly or not at all, which keeps both documents' expected
words and the pair's exact sum.  The one that stays fractional meets the next
document.  Blocks of about ``BLOCK`` documents are reduced side by side, each
leaving one residual; the residuals are blocks of the next level, up to one
residual per source.  That last one goes to the nearer side, so a source's
total is off by half a document at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD, Scratch, columns, fresh, numbered

#: Documents (or residuals) that one fold of the reduction tree takes, on average.
BLOCK = 128


def word_count(text: Column) -> Column:
    """Number of words of a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_level(sizes: DataFrame, weights: list[int], share: float, most: float) -> DataFrame:
    """Target per source: ``sizes`` (source, source_size) with target added.

    Sources in code point order, null last, get ``weights`` in turn.  Capping
    and resharing in rounds ends where every uncapped source has ``level`` *
    weight and every other one its cap; with the sources in order of cap /
    weight, that level is the largest of the levels that result if exactly
    the sources before each one are capped.  The table has one row per
    source, so its windows run in one task.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    all_rows = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_cap = Window.orderBy("_ratio", "_turn")
    out = (sizes.withColumn("_turn", turn)
           .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("_turn") % len(weights) + 1).cast("int")))
           .withColumn("_cap", F.col("source_size") * F.lit(float(most)))
           .withColumn("_ratio", F.col("_cap") / F.col("weight"))
           .withColumn("_all", F.sum("source_size").over(all_rows) * F.lit(float(share)))
           .withColumn("_full", F.coalesce(F.sum("_cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
           .withColumn("_rest", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
           .withColumn("_level", F.max((F.col("_all") - F.col("_full")) / F.col("_rest")).over(all_rows))
           .withColumn("target", F.least("_cap", F.greatest(F.lit(0.0), F.col("_level") * F.col("weight")))))
    return out.select("source", "source_size", "weight", "target")


def _unit(draw: Column) -> Column:
    """A 64-bit hash as a number in [0, 1)."""
    return F.shiftrightunsigned(draw, 11).cast("double") / F.lit(float(1 << 53))


def _fold(units: Column, seed: int) -> Column:
    """Reduce an array of units (uid, doc_id, size, i, mass) to (rest, done).

    ``done`` holds the units that became integral with ``up`` 0 or 1, ``rest``
    the one that is left.
    """
    def step(acc: Column, u: Column) -> Column:
        r = acc["rest"]
        a, b, room_r, room_u = r["mass"], u["mass"], r["size"] - r["mass"], u["size"] - u["mass"]
        gain, loss = F.least(room_r, b), F.least(a, room_u)
        raise_r = (gain + loss == 0) | (_unit(F.xxhash64(F.lit(seed), r["uid"], u["uid"])) * (gain + loss) < loss)
        # which of the two is settled, at what, and the other's mass
        settle_r = F.when(raise_r, room_r <= b).otherwise(a <= room_u)
        up = F.when(raise_r, settle_r).otherwise(~settle_r).cast("int")
        mass = (F.when(raise_r & settle_r, b - room_r).when(raise_r, a + b)
                .when(settle_r, a + b).otherwise(a - room_u))
        left = F.when(settle_r, u.withField("mass", mass)).otherwise(r.withField("mass", mass))
        gone = F.when(settle_r, r).otherwise(u)
        met = F.struct(left.alias("rest"), F.concat(acc["done"], F.array(gone.withField("up", up))).alias("done"))
        return F.when(r.isNull(), F.struct(u.alias("rest"), acc["done"].alias("done"))).otherwise(met)

    none = F.struct(
        F.lit(None).cast("struct<uid:bigint,doc_id:bigint,size:bigint,i:bigint,mass:double>").alias("rest"),
        F.array().cast("array<struct<uid:bigint,doc_id:bigint,size:bigint,i:bigint,mass:double,up:int>>").alias("done"))
    return F.aggregate(units, none, step)


def mix(docs: DataFrame, weights: list[int] | None = None, share: float = 1.5, most: float = 2.0,
        seed: int = 1) -> DataFrame:
    """Copies per document: (doc_id, source, size, i, source_size, target, copies).

    ``docs`` has doc_id (long), source and text.  One row per row of ``docs``;
    rows alike in doc_id, source and size are told apart by ``i`` (0, 1, ...)
    only, and are counted, not gathered, until chunks of their units are dealt
    to tasks, so that neither a source nor an id with a third of all rows makes a large
    task.  All draws are hashes of the unit and ``seed``: a rerun, on any
    layout of the input, agrees.

    Nulls: a null or blank text has size 0 and is never taken beyond the
    sure copies; a null source is a source of its own, last in order; a null
    doc_id is an id like any other.  Empty input gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    alike = scratch.keep(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
        .groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")), "alike")
    totals = alike.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"),
                                         F.sum("n").alias("units"))
    plan = scratch.keep(
        water_level(totals.select("source", "source_size"), weights or [3, 1, 2], share, most)
        .withColumnRenamed("source", "_s").join(totals.select("source", "units"), F.col("_s").eqNullSafe(F.col("source")))
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .select("source", "source_size", "target", "units", F.floor("rate").cast("int").alias("sure"),
                (F.col("rate") - F.floor("rate")).alias("part")), "plan")
    units = (alike.join(plan.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
             .select("doc_id", "source", "size", "units", "part", "n"))
    units = numbered(units, "n", "i").drop("n")
    rounded = _rounded(spark, scratch, units, plan, seed)
    whole = units.where((F.col("size") == 0) | (F.col("part") == 0)).select("doc_id", "source", "size", "i", F.lit(0).alias("up"))
    return (whole.unionByName(rounded)
            .join(plan.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
            .select("doc_id", "source", "size", "i", "source_size", "target", (F.col("sure") + F.col("up")).alias("copies")))


def _rounded(spark: SparkSession, scratch: Scratch, units: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Fractional units rounded by the reduction tree: doc_id, source, size, i, up."""
    uid = F.xxhash64(F.lit(seed), "doc_id", "source", "size", "i")
    blocks = F.ceil(F.col("units") / F.lit(BLOCK)).cast("long")
    level = (units.where((F.col("size") > 0) & (F.col("part") > 0))
             .select("source", F.pmod(F.xxhash64(F.lit("block"), uid), blocks).alias("block"),
                     F.struct(uid.alias("uid"), "doc_id", "size", "i", (F.col("part") * F.col("size")).alias("mass")).alias("u")))
    most = plan.agg(F.max("units")).first()[0] or 0
    left, parts = max(1, -(-most // BLOCK)), []
    while True:
        folded = scratch.keep(
            level.groupBy("source", "block").agg(F.sort_array(F.collect_list("u")).alias("us"))
            .select("source", "block", _fold(F.col("us"), seed).alias("f"))
            .select("source", "block", "f.rest", "f.done"), "level")
        parts.append(folded.select("source", F.explode("done").alias("d"))
                     .select("d.doc_id", "source", "d.size", "d.i", "d.up"))
        if left == 1:
            break
        left = -(-left // BLOCK)
        level = folded.select("source", F.floor(F.col("block") / BLOCK).cast("long").alias("block"), F.col("rest").alias("u"))
    # a source's last document has no partner: rounded to the nearer side, half its words off at most
    near = F.col("rest.mass") * 2 >= F.col("rest.size")
    out = folded.select("rest.doc_id", "source", "rest.size", "rest.i", near.cast("int").alias("up"))
    for p in parts:
        out = out.unionByName(p)
    return out


def apply_mix(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The mixed documents: every row of ``docs`` repeated as often as ``plan`` (from ``mix``) says.

    Rows alike in doc_id, source and word count share their group's copies:
    the group's rows, in text order, take the larger numbers last.  Columns
    are those of ``docs``.
    """
    d, s, w, c = (fresh(docs, n) for n in ("_d", "_s", "_w", "_c"))
    keyed = docs.withColumns({d: F.col("doc_id"), s: F.col("source"), w: word_count(F.col("text"))})
    doc, source, size, n, low, total = (fresh(keyed, x) for x in ("_doc", "_source", "_size", "_n", "_low", "_sum"))
    tally = (plan.groupBy(F.col("doc_id").alias(doc), F.col("source").alias(source), F.col("size").alias(size))
             .agg(F.count(F.lit(1)).alias(n), F.min("copies").alias(low), F.sum(F.col("copies").cast("long")).alias(total)))
    joined = keyed.join(tally, keyed[d].eqNullSafe(tally[doc]) & keyed[s].eqNullSafe(tally[source]) & (keyed[w] == tally[size]))
    nth = F.row_number().over(Window.partitionBy(doc, source, size).orderBy(F.xxhash64("text"), F.xxhash64(*columns(docs))))
    # copies differ by at most one within a group: the last rows get the higher number
    high = F.col(total) - F.col(low) * F.col(n)
    copies = (F.col(low) + (nth > F.col(n) - high).cast("int")).cast("int")
    return (joined.withColumn(c, copies).where(F.col(c) > 0)
            .withColumn(c, F.explode(F.sequence(F.lit(1), F.col(c)))).select(*columns(docs)))
