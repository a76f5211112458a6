"""Tables: logical table name -> lazily built DataFrame.

Two views of the same data exist: the multi-tenant one (every table carries
``credit_union``) and the single-tenant one (no tenant column; code columns
in their comparison form with the stored text beside them, see
``sources.collation``).  In production a caller builds ``Tables`` from its
catalog with ``Tables.from_catalog``; the tests bind the driver's parquet
files through ``Tables.from_dir``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DecimalType, IntegralType

from ledgerline.sources import fixtures
from ledgerline.sources.collation import st_view

# Columns that the reports sum as integer cents.
MONEY = {"transaction_history": ("total_amount",), "gl_history": ("amount",), "account": ("current_balance",)}


def check_money(name: str, df: DataFrame) -> DataFrame:
    """Refuse a money column whose values cents cannot hold exactly.

    A double or a finer decimal has no exact cents, and rounding each row is
    not what a rounded sum is; the caller must decide how to round.
    """
    for c in MONEY.get(name, ()):
        if c in df.columns:
            kind = df.schema[c].dataType
            if not (isinstance(kind, IntegralType) or isinstance(kind, DecimalType) and kind.scale <= 2):
                raise TypeError(f"{name}.{c} is {kind.simpleString()}; money columns must be decimals of at most two "
                                "decimals, e.g. CAST(... AS DECIMAL(18,2))")
    return df


class Tables(Mapping):
    def __init__(self, loaders: Mapping[str, Callable[[], DataFrame]], tenancy: str):
        self._loaders = dict(loaders)
        self._cache: dict[str, DataFrame] = {}
        self.tenancy = tenancy  # "mt" or "st"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            df = check_money(name, self._loaders[name]())
            self._cache[name] = st_view(name, df) if self.tenancy == "st" else df
        return self._cache[name]

    def __iter__(self):
        return iter(self._loaders)

    def __len__(self):
        return len(self._loaders)

    @classmethod
    def from_frames(cls, frames: Mapping[str, DataFrame], tenancy: str = "mt") -> "Tables":
        return cls({k: (lambda v=v: v) for k, v in frames.items()}, tenancy)

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: Mapping[str, str], tenancy: str = "mt") -> "Tables":
        """Bind logical names to catalog tables, e.g. {"account": "lake.cu.account"}."""
        return cls({k: (lambda v=v: spark.table(v)) for k, v in names.items()}, tenancy)

    @classmethod
    def from_dir(cls, spark: SparkSession, sf_dir: str, tenancy: str = "mt") -> "Tables":
        """Bind the 18 logical tables to the driver parquet files in ``sf_dir``."""
        driver: dict[str, DataFrame] = {}

        def drv(name: str) -> DataFrame:
            if name not in driver:
                driver[name] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
            return driver[name]

        def load(name: str) -> DataFrame:
            build = fixtures.st_sql if tenancy == "st" else fixtures.logical_sql
            sql = build(name, "spark", lambda t: "{" + t + "}")
            used = {t: drv(t) for t in fixtures.DRIVER_TABLES if "{" + t + "}" in sql}
            return spark.sql(sql, **used)

        names = [n for n in fixtures.COLUMNS if not (tenancy == "st" and n == "fi_map")]
        return cls({n: (lambda n=n: load(n)) for n in names}, tenancy)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, tenancy: str = "mt") -> "Tables":
        """Bind logical tables stored as ``<root>/<name>`` parquet directories."""
        names = [n for n in fixtures.COLUMNS if not (tenancy == "st" and n == "fi_map")]
        return cls({n: (lambda n=n: spark.read.parquet(f"{root.rstrip('/')}/{n}")) for n in names}, tenancy)

    def write(self, root: str, files: int | None = None) -> None:
        """Store every table as ``<root>/<name>`` parquet (overwrite), spread
        over ``files`` files when given (round robin), as a lake table is."""
        for n in self:
            df = self[n] if files is None else self[n].repartition(files)
            df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{n}")
