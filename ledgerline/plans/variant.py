"""MT / ST variant: everything that differs between the two report dialects.

MT (multi-tenant): every table has ``credit_union``; it is part of every join
and grouping key, and codes are normalized with upper(trim()) where the
report text does so.  ST (single-tenant): no tenant column; ``Tables`` holds
the code columns in their comparison form (``sources.collation``), so
comparisons are bare, and keeps the stored text for printing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.sources.collation import STORED

TENANT = "credit_union"


@dataclass(frozen=True)
class Variant:
    name: str  # "mt" or "st"

    @property
    def mt(self) -> bool:
        return self.name == "mt"

    @property
    def keys(self) -> list[str]:
        """Tenant key columns ([] for ST)."""
        return [TENANT] if self.mt else []

    def stored(self, c: str) -> Column:
        """The text of a code column as the database stores it."""
        return F.col(c) if self.mt else F.col(f"{STORED}{c}")

    def norm(self, c) -> Column:
        """upper(trim(c)) in MT; in ST the tables hold comparison forms."""
        c = F.col(c) if isinstance(c, str) else c
        return F.upper(F.trim(c)) if self.mt else c

    def order(self, *names: str) -> list[Column]:
        """ORDER BY keys, ``-name`` for descending ones, with the dialect's place of nulls: always last in
        the multi-tenant engine; smallest (first ascending, last descending) in the single-tenant one."""
        out = []
        for n in names:
            if n.startswith("-"):
                out.append(F.col(n[1:]).desc_nulls_last())
            else:
                out.append(F.col(n).asc_nulls_last() if self.mt else F.col(n).asc_nulls_first())
        return out


MT = Variant("mt")
ST = Variant("st")
