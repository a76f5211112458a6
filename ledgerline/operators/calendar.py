"""Month calendar and zero-filled key x month grids (O1, O3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def month_start(d: dt.date) -> dt.date:
    return d.replace(day=1)


def add_months(d: dt.date, n: int) -> dt.date:
    m = d.year * 12 + (d.month - 1) + n
    return dt.date(m // 12, m % 12 + 1, 1)


def month_sequence(start: dt.date, end: dt.date) -> Column:
    """Array of first days of month from ``start`` to ``end`` (both month starts)."""
    if start > end:
        return F.array().cast("array<date>")
    return F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 MONTH"))


def month_calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """O1: one row per first day of month in [start, end]."""
    return spark.range(1).select(F.explode(month_sequence(month_start(start), month_start(end))).alias("period_start"))


def grid_window(gl_start: dt.date, as_of: dt.date, months: int) -> tuple[dt.date, dt.date]:
    """First and last month of a ``months``-month look-back grid ending at as_of's month."""
    last = month_start(as_of)
    first = max(month_start(gl_start), add_months(last, -months))
    return first, last


def zero_filled_grid(keys: DataFrame, first: dt.date, last: dt.date, facts: DataFrame, on: list[str],
                     fill: dict[str, Column], period: str = "period_start") -> DataFrame:
    """O3: every key row x every month in [first, last] with the measures of
    ``facts`` (at most one row per ``on`` and month), missing ones replaced by
    ``fill``.

    The facts are brought to one row per key (a map with at most one entry per
    month), joined to the key rows, and only then are the months generated per
    row, so neither relations are crossed nor grid rows shuffled: the result
    stays partitioned on ``on``, as a per-key window needs it.
    """
    measures = list(fill)
    per_key = (facts.where(F.col(period).isNotNull()).groupBy(*on)
               .agg(F.map_from_entries(F.collect_list(F.struct(F.col(period), F.struct(*measures)))).alias("_facts")))
    months = F.transform(month_sequence(first, last),
                         lambda m: F.struct(m.alias(period), F.try_element_at(F.col("_facts"), m).alias("_f")))
    return (keys.repartition(*on).join(per_key, on, "left")
            .select(*keys.columns, F.explode(months).alias("_m"))
            .select(*keys.columns, f"_m.{period}", *[F.coalesce(F.col(f"_m._f.{c}"), v).alias(c) for c, v in fill.items()]))
