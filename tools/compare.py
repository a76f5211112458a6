"""Order-insensitive comparison of a Spark result and a DuckDB result."""
from __future__ import annotations

import datetime as dt
import decimal
import math
import os


STRICT = os.environ.get("LEDGERLINE_STRICT") == "1"


def canon(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "<null>"
        return f"f{v!r}" if STRICT else f"f{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return f"d{v}"
    if isinstance(v, bool):
        return f"b{v}"
    if isinstance(v, int):
        return f"i{v}"
    if isinstance(v, dt.datetime):
        return f"t{v.replace(tzinfo=None).isoformat()}"
    if isinstance(v, dt.date):
        return f"t{v.isoformat()}"
    return f"s{v}"


def rows_of(table) -> tuple[list[str], list[tuple]]:
    cols = list(table.column_names)
    data = table.to_pylist()
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    keys = [cols[i].lower() for i in order]
    rows = sorted(tuple(canon(r[cols[i]]) for i in order) for r in data)
    return keys, rows


def compare(spark_tbl, duck_tbl, show: int = 3) -> tuple[bool, str]:
    ks, rs = rows_of(spark_tbl)
    kd, rd = rows_of(duck_tbl)
    if ks != kd:
        return False, f"columns differ: spark-only {sorted(set(ks)-set(kd))} duck-only {sorted(set(kd)-set(ks))}"
    types = []
    for f in spark_tbl.schema:
        g = duck_tbl.schema.field(duck_tbl.column_names.index(f.name))
        if str(f.type) != str(g.type):
            types.append(f"{f.name}: {f.type} vs {g.type}")
    if len(rs) != len(rd):
        return False, f"rows {len(rs)} vs {len(rd)}; types {types}"
    if rs == rd:
        return True, ("types: " + "; ".join(types)) if types else ""
    bad = [(a, b) for a, b in zip(rs, rd) if a != b]
    msg = [f"{len(bad)} differing rows; types {types}"]
    for a, b in bad[:show]:
        diffs = [(ks[i], a[i], b[i]) for i in range(len(ks)) if a[i] != b[i]]
        msg.append(f"  {diffs[:6]}")
    return False, "\n".join(msg)
