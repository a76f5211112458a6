"""Table bindings: catalog names and stored parquet give the same reports."""

from ledgerline import registry
from ledgerline.params import FIXTURE_PARAMS
from ledgerline.sources.tables import Tables
from tools.compare import compare


def test_catalog_and_parquet_bindings(spark, sf, tmp_path):
    base = Tables.from_dir(spark, sf, "mt")
    root = str(tmp_path / "mt")
    base.write(root, files=3)
    stored = Tables.from_parquet(spark, root, "mt")
    names = {}
    for n in stored:
        stored[n].createOrReplaceTempView(f"lake_{n}")
        names[n] = f"lake_{n}"
    catalog = Tables.from_catalog(spark, names, "mt")
    plan, _, v = registry.report("mt_member_profile")
    a = plan(base, FIXTURE_PARAMS, v).toArrow()
    for tabs in (stored, catalog):
        ok, msg = compare(a, plan(tabs, FIXTURE_PARAMS, v).toArrow())
        assert ok, msg


def test_unordered_report_same_rows(spark, sf):
    import dataclasses
    plan, _, v = registry.report("mt_products_overview")
    t = Tables.from_dir(spark, sf, "mt")
    a = plan(t, FIXTURE_PARAMS, v)
    b = plan(t, dataclasses.replace(FIXTURE_PARAMS, ordered=False), v)
    assert "Sort [" in a._jdf.queryExecution().executedPlan().toString()
    ok, msg = compare(a.toArrow(), b.toArrow())
    assert ok, msg
