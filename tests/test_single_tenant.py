"""Single-tenant comparisons hold for every way of binding tables, and print what is stored."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerline import registry
from ledgerline.params import FIXTURE_PARAMS
from ledgerline.sources import fixtures
from ledgerline.sources.collation import CODES, st_view
from ledgerline.sources.tables import Tables
from tools.compare import compare

ST = sorted(k for k in registry.queries() if k.startswith("st_"))


@pytest.fixture(scope="module")
def raw(spark, sf, tmp_path_factory):
    """The stored tables without any normalisation, as files, views and frames."""
    root = str(tmp_path_factory.mktemp("st_raw"))
    con = duckdb.connect()
    for t in fixtures.DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    names = [n for n in fixtures.COLUMNS if n != "fi_map"]
    for n in names:
        used = {t: spark.read.parquet(f"{sf}/{t}.parquet") for t in fixtures.DRIVER_TABLES}
        sql = fixtures.st_sql(n, "spark", lambda t: "{" + t + "}")
        spark.sql(sql, **{t: df for t, df in used.items() if "{" + t + "}" in sql}).write.parquet(f"{root}/{n}")
    frames = {n: spark.read.parquet(f"{root}/{n}") for n in names}
    for n, df in frames.items():
        assert not any(c.startswith("stored_") for c in df.columns)
        df.createOrReplaceTempView(f"st_lake_{n}")
    return {"parquet": Tables.from_parquet(spark, root, "st"), "frames": Tables.from_frames(frames, "st"),
            "catalog": Tables.from_catalog(spark, {n: f"st_lake_{n}" for n in names}, "st")}


@pytest.mark.parametrize("key", ST)
def test_raw_tables_give_the_registered_rows(spark, sf, raw, key):
    plan, _, v = registry.report(key)
    want = E.queries()[key](spark, sf).toArrow()
    assert want.num_rows > 0
    for tables in raw.values():
        ok, msg = compare(plan(tables, FIXTURE_PARAMS, v).toArrow(), want)
        assert ok, msg


def test_case_and_trailing_blanks_are_equal_leading_blanks_are_not(spark):
    df = spark.createDataFrame([("l",), ("L ",), (" L",), (None,)], "discriminator string")
    rows = st_view("account", df).collect()
    assert [r["discriminator"] for r in rows] == ["L", "L", " L", None]
    assert [r["stored_discriminator"] for r in rows] == ["l", "L ", " L", None]
    again = st_view("account", st_view("account", df))
    assert again.columns == ["discriminator", "stored_discriminator"]


def test_stored_text_is_printed(spark, sf):
    types = {r[0] for r in E.queries()["st_accounts_transactions"](spark, sf).select("account_type").distinct().collect()}
    assert any(t != t.upper() or t != t.strip() for t in types)
    rows = E.queries()["st_gl_accounts_transactions"](spark, sf).select("Txn_Type", "Txn_Type_Description").distinct().collect()
    assert ("eod ", "End of Day Processing") in {tuple(r) for r in rows}


def test_codes_name_columns_of_the_tables():
    assert all(set(codes) <= set(fixtures.COLUMNS[name]) for name, codes in CODES.items())


def test_gl_numbers_compare_as_numbers(spark):
    from ledgerline.functions.gl import gl_account_canon
    df = spark.createDataFrame([("00101.0",), (" 101.0",), ("101.0 ",)], "x string")
    assert {r[0] for r in df.select(gl_account_canon(F.col("x"))).collect()} == {"101.0"}
