"""Tenant-level enrichments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tenant_enrich(df: DataFrame, fi_map: DataFrame, exact: bool) -> DataFrame:
    """Add ``idfi`` by a left join of the tenant map on the tenant key.

    ``exact`` joins ``tenant_code = credit_union``; otherwise both sides are
    compared as lower(trim()).  The map has one row per tenant, so Spark's
    size-checked broadcast picks it up; no hint is forced.
    """
    fi = fi_map.select(F.col("tenant_code").alias("_fi_code"), "idfi")
    if exact:
        cond = df["credit_union"] == fi["_fi_code"]
    else:
        cond = F.lower(F.trim(df["credit_union"])) == F.lower(F.trim(fi["_fi_code"]))
    return df.join(fi, cond, "left").drop("_fi_code")


def cu_names(credit_union_info: DataFrame) -> DataFrame:
    """O20 (MT): distinct (credit_union, credit_union_name)."""
    return credit_union_info.select("credit_union", "credit_union_name").distinct()


def cu_name_scalar(credit_union_info: DataFrame):
    """O20 (ST): the first credit-union name by name, as a scalar subquery column.

    Spark evaluates it once (one row) and inlines it, instead of crossing the
    report with a one-row table.
    """
    return (credit_union_info.select("credit_union_name")
            .orderBy("credit_union_name").limit(1).scalar())
