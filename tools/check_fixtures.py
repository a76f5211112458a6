"""Compare every logical table between Spark and DuckDB (both tenancies)."""
import sys
import duckdb
from ledgerline.session import build_session
from ledgerline.sources import fixtures
from ledgerline.sources.tables import Tables
from tools.compare import compare

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
spark = build_session()
con = duckdb.connect()
for t in fixtures.DRIVER_TABLES:
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
for ten in ("mt", "st"):
    tabs = Tables.from_dir(spark, sf, ten)
    for n in tabs:
        build = fixtures.st_sql if ten == "st" else fixtures.logical_sql
        ok, msg = compare(tabs[n].toArrow(), con.sql(build(n, "duckdb")).to_arrow_table())
        print(ten, n, "OK" if ok else "DIFF", msg)
