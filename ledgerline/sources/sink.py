"""Writing a report's rows to a table whose files are in the report's order.

A global sort samples its input first, so everything below it runs twice.
Here the rows are written once as they come, and the sort reads them from
there: the sample scans only the order's columns of a written table.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame

from ledgerline import registry
from ledgerline.params import Params
from ledgerline.sources.tables import Tables

#: ORDER BY of the reports whose rows are as many as their facts' or accounts', by plan: columns, ``-`` for descending.
ORDER: dict[str, tuple[str, ...]] = {
    "gl_accounts_transactions": ("-Effective_Date", "-Transaction_ID"),
    "account_transactions": ("-month_year", "account_category", "account_number"),
    "member_profile": ("member_id",),
    "loans_applications": ("-application_date", "-application_id"),
    "loans_general": ("Member_ID", "Loan_ID"),
    "cards_general": ("credit_union", "member_id", "card_source", "card_type", "-creation_date"),
}


def write_sorted(rows: DataFrame, path: str, order: list[Column], files: int) -> DataFrame:
    """Write ``rows`` to at most ``files`` parquet files: sorted inside, and by name from the first range to the last.

    The unsorted rows are a written table beside ``path`` while this runs.
    Rows that are equal in ``order`` lie in one file (ranges are cut between
    values), so pass an order that tells rows apart where one value has many.
    An empty result is an empty table.
    """
    spark = rows.sparkSession
    aside = f"{path.rstrip('/')}.unsorted"
    rows.write.mode("overwrite").parquet(aside)
    (spark.read.schema(rows.schema).parquet(aside).repartitionByRange(files, *order).sortWithinPartitions(*order)
     .write.mode("overwrite").parquet(path))
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(aside)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return spark.read.schema(rows.schema).parquet(path)


def write_report(tables: Tables, key: str, params: Params, path: str, files: int = 200) -> DataFrame:
    """Write report ``key`` over ``tables`` to ``path``, in its order where ``ORDER`` has one; returns the written table.

    The dialect's place of nulls is that of the report.
    """
    plan, _, v = registry.report(key)
    rows = plan(tables, dataclasses.replace(params, ordered=False), v)
    names = [n for n in ORDER.get(plan.__name__, ()) if n.lstrip("-") in rows.columns]
    if not names:
        rows.write.mode("overwrite").parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)
    return write_sorted(rows, path, v.order(*names), files)
