"""Reports written as tables whose files follow the report's order."""

import functools
import glob
import os

import pyarrow.parquet as pq
import pytest

from ledgerline import registry
from ledgerline.params import FIXTURE_PARAMS
from ledgerline.sources import sink
from ledgerline.sources.tables import Tables
from tests.test_order import BY_KEY, compare_rows

KEYS = ["st_gl_accounts_transactions", "mt_account_transactions", "st_accounts_transactions", "mt_loans_applications", "st_cards_general"]


@pytest.mark.parametrize("key", KEYS)
def test_files_by_name_are_in_report_order(spark, sf, tmp_path, key):
    path = str(tmp_path / key)
    plan, _, v = registry.report(key)
    tables = Tables.from_dir(spark, sf, v.name)
    written = sink.write_report(tables, key, FIXTURE_PARAMS, path, files=5)
    assert not os.path.exists(path + ".unsorted")
    files = sorted(glob.glob(f"{path}/*.parquet"))
    assert 1 < len(files) <= 5
    rows = [r for f in files for r in pq.read_table(f).to_pylist()]
    compare = functools.partial(compare_rows, BY_KEY[key], v.mt)
    assert rows and all(compare(a, b) <= 0 for a, b in zip(rows, rows[1:]))
    want = plan(tables, FIXTURE_PARAMS, v)
    assert written.columns == want.columns and written.exceptAll(want).isEmpty() and want.exceptAll(written).isEmpty()


def test_orders_name_columns_of_their_report(spark, sf):
    for key in registry.queries():
        plan, _, v = registry.report(key)
        if plan.__name__ in sink.ORDER:
            columns = plan(Tables.from_dir(spark, sf, v.name), FIXTURE_PARAMS, v).columns
            assert {n.lstrip("-") for n in sink.ORDER[plan.__name__]} - set(columns) <= ({"credit_union"} if not v.mt else set())


def test_unordered_and_empty_reports(spark, sf, tmp_path):
    tables = Tables.from_dir(spark, sf, "mt")
    out = sink.write_report(tables, "mt_member_status_dim", FIXTURE_PARAMS, str(tmp_path / "dim"))
    assert out.count() == tables["member"].count()
    none = Tables.from_frames({n: tables[n].limit(0) for n in tables}, "mt")
    assert sink.write_report(none, "mt_account_transactions", FIXTURE_PARAMS, str(tmp_path / "none"), 3).collect() == []
