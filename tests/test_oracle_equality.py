"""Every report key equals its DuckDB statement on the small fixture."""

import pytest

import __spark_entry__ as E
from ledgerline import registry
from tools.compare import compare

KEYS = sorted(registry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_report_matches_oracle(spark, duck, sf, key):
    got = E.queries()[key](spark, sf).toArrow()
    sql = E.oracle_sql().get(key)
    assert sql is not None, f"{key} has no oracle"
    ok, msg = compare(got, duck.sql(sql).to_arrow_table())
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "approximate_beginning_balance" in df.columns
