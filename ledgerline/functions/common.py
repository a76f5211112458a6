"""Small shared Column helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(38,2)"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def case_map(c, mapping: dict, default=None) -> Column:
    """Simple CASE: ``CASE c WHEN k THEN v ... ELSE default END``."""
    c = col(c)
    out = None
    for k, v in mapping.items():
        out = (F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v)))
    return out.otherwise(F.lit(default)) if default is not None else out


def year_range(c, year: int) -> Column:
    """``year(c) = year`` written as a half-open range so it reaches the scan."""
    c = col(c)
    return (c >= F.lit(dt.date(year, 1, 1))) & (c < F.lit(dt.date(year + 1, 1, 1)))


def to_cents(c) -> Column:
    """A decimal money value of at most two decimals as exact integer cents (bigint).

    Aggregating cents runs on primitive longs inside whole-stage codegen,
    where sums of decimal(18,2) widen to object-backed decimal(28+) buffers.
    The cast would cut off anything finer, so ``Tables`` refuses money columns
    of any other type when they are bound (``sources.tables.MONEY``).
    """
    return (col(c) * 100).cast("bigint")


def from_cents(c) -> Column:
    """Integer cents back to an exact decimal(38,2)."""
    from decimal import Decimal
    return (col(c).cast("decimal(38,0)") * F.lit(Decimal("0.01"))).cast(MONEY_SUM)
