"""Joins, sums and copies that a hot key does not bring into one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Parts that a key of the large side is dealt to.
SALTS = 4
#: Parts that a key is dealt to where only the parts that occur get the key's figures.
PARTS = 32
#: Parts that a key is dealt to where the dimension has a few rows only: enough for all parts of a shuffle.
SPREAD = 256
#: Copies of a row that a task makes in one go.
COPIES = 10_000


def salted_left_join(rows: DataFrame, dim: DataFrame, on: list[str], by: list[Column], salts: int = SALTS) -> DataFrame:
    """``rows`` LEFT JOIN ``dim`` on ``on``, the rows of a key dealt to ``salts`` parts by a hash of ``by``.

    ``dim`` is repeated once per part.  Adaptive execution splits a partition
    only between two plain shuffles; a dimension that is itself an aggregate
    on the join key is none, but with the part in the key it is shuffled
    anew, so hot parts split further.  The result does not depend on the
    parts.
    """
    parts = F.sequence(F.lit(0), F.lit(salts - 1))
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))
    return dealt.join(dim.withColumn("_part", F.explode(parts)), on + ["_part"], "left").drop("_part")


def with_own_figures(packed: DataFrame, on: list[str], by: list[Column], figures: dict[str, Column],
                     finish: Callable[[DataFrame], DataFrame], nullable: list[str] | None = None) -> DataFrame:
    """Rows with figures that are summed over the rows of their own key; the rows are computed and shuffled once.

    ``packed`` has the key columns ``on`` and ``_rows``, a non-empty array of
    structs, the rows.  They are dealt by key and a hash of ``by`` to at most
    ``PARTS`` parts per key, and that one exchange feeds two consumers: the
    sums of ``figures`` (name -> integer column over ``_rows``) per part, then
    per key, and the join that brings ``finish`` of the sums (one row per key,
    further columns welcome) back to the parts that occur.  A key's figures
    are repeated at most once per row of the key, and a hot key is ``PARTS``
    partitions.  Both consumers need whole ``_rows``, so that the optimizer
    prunes the same columns for both and the exchange is one (and the rows
    are unpacked by an outer generator, which implies no filter below).

    Returns ``on``, the columns of the rows, and those of ``finish``.  A null
    key has no figures; a null travels as a default and a mark (for the
    columns in ``nullable``, all if not given), because a join on nullable
    columns would filter one consumer only.  For the same
    reason filters on the key (also those that a later inner join implies)
    belong on ``packed``: behind, they reach one consumer, and the rows are
    computed twice.
    """
    kinds = {f.name: f.dataType for f in packed.schema.fields}
    marked = [c for c in on if nullable is None or c in nullable]
    at = [f"_key_{c}" for c in on] + [f"_null_{c}" for c in marked]

    def shuffled_keys() -> list[Column]:
        default = {c: F.lit("" if isinstance(kinds[c], StringType) else 0).cast(kinds[c]) for c in marked}
        return ([(F.coalesce(F.col(c), default[c]) if c in marked else F.col(c)).alias(f"_key_{c}") for c in on]
                + [F.col(c).isNull().alias(f"_null_{c}") for c in marked])

    own_keys = [(F.when(~F.col(f"_null_{c}"), F.col(f"_key_{c}")) if c in marked else F.col(f"_key_{c}")).alias(c) for c in on]
    part = F.pmod(F.xxhash64(*by), F.lit(PARTS)).cast("int").alias("_part")
    dealt = packed.select(*shuffled_keys(), part, "_rows").repartition(*at, "_part")
    of_part = dealt.groupBy(*at, "_part").agg(*[F.sum(c).alias(n) for n, c in figures.items()])
    of_key = of_part.groupBy(*at).agg(*[F.sum(n).alias(n) for n in figures], F.collect_list("_part").alias("_parts"))
    dim = finish(of_key.select(*own_keys, *figures, "_parts"))
    own = [c for c in dim.columns if c not in (*on, "_parts")]
    known = F.lit(True)
    for c in marked:
        known = known & ~F.col(f"_null_{c}")
    dim = (dim.select(*shuffled_keys(), F.explode("_parts").alias("_part"), *own)
           .select(*at, "_part", *[F.when(known, F.col(c)).alias(c) for c in own]))
    return dealt.join(dim, at + ["_part"], "left").select(*own_keys, F.inline_outer("_rows"), *own)


def repeated(rows: DataFrame, times: Column, by: list[Column], order: list[Column] | None = None) -> DataFrame:
    """Every row ``times`` times (at least once), in the given order if there is one.

    A row is numbered in chunks of ``COPIES`` first, the chunks are dealt to
    tasks (by the sort, or by a hash of ``by`` and the chunk), and the copies
    are made where the chunk lies: neither an array nor a task holds all
    copies of a row, and the copies themselves are not shuffled.
    """
    times = F.greatest(F.coalesce(times, F.lit(1)), F.lit(1)).cast("bigint")
    last = F.call_function("div", F.col("_times") - 1, F.lit(COPIES).cast("bigint"))
    chunks = (rows.withColumn("_times", times)
              .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last))))
    moved = chunks.orderBy(*order, "_chunk") if order else chunks.repartition(*by, "_chunk")
    left = F.least(F.lit(COPIES).cast("bigint"), F.col("_times") - F.col("_chunk") * COPIES)
    return (moved.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), left)))
            .drop("_times", "_chunk", "_copy"))
