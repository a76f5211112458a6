"""Plan properties: pushdown, no Python UDFs, no cross joins, shared exchanges."""

import re

import pytest

from ledgerline import registry
from ledgerline.params import FIXTURE_PARAMS
from ledgerline.sources.tables import Tables


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    out = {}
    for tenancy in ("mt", "st"):
        root = str(tmp_path_factory.mktemp(f"tables_{tenancy}"))
        Tables.from_dir(spark, sf, tenancy).write(root)
        out[tenancy] = Tables.from_parquet(spark, root, tenancy)
    return out


def plan_text(stored, key):
    plan, _, v = registry.report(key)
    df = plan(stored[v.name], FIXTURE_PARAMS, v)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(registry.queries()))
def test_no_python_udf_no_cross_join(stored, key):
    text = plan_text(stored, key)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text, f"{key}: {bad}"


def test_current_year_filter_reaches_scan(stored):
    text = plan_text(stored, "mt_account_transactions")
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(date_effective,2001-01-01\)", text)
    assert re.search(r"LessThan\(date_effective,2002-01-01\)", text)


def test_gl_grid_window_shares_one_exchange(stored):
    text = plan_text(stored, "mt_gl_accounts_general")
    # journal window cut reaches the scan
    assert re.search(r"GreaterThanOrEqual\(effective_date,1998-07-01\)", text)
    # running sum and LAG: two Window operators stacked over one sort and one exchange
    lines = text.splitlines()
    win = [i for i, ln in enumerate(lines) if "Window [" in ln]
    assert len(win) == 2
    between = lines[win[0] + 1:win[1]]
    assert not any("Exchange" in ln or "Sort [" in ln for ln in between)
    assert "Generate explode" in text


def test_scan_prunes_columns(stored):
    text = plan_text(stored, "mt_member_key_trends")
    m = re.search(r"Location: [^\n]*account\], PartitionFilters: \[\], PushedFilters: [^\n]*ReadSchema: (struct<[^>]*>)",
                  text)
    assert m is not None
    assert "description" not in m.group(1) and "date_opened" not in m.group(1)


@pytest.mark.parametrize("key", ["mt_gl_accounts_general", "st_gl_accounts_general"])
def test_gl_grid_rows_are_not_shuffled(spark, stored, key):
    """Without broadcasts, months are generated after the one shuffle on the account key and feed the window."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for n in names:
        spark.conf.set(n, "-1")
    try:
        lines = plan_text(stored, key).splitlines()
    finally:
        for n in names:
            spark.conf.unset(n)
    window = [i for i, ln in enumerate(lines) if "Window [" in ln]
    grid = next(i for i, ln in enumerate(lines) if "Generate explode" in ln)
    assert window[0] < window[1] < grid
    assert not any("Exchange" in ln for ln in lines[window[0]:grid])
