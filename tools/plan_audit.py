"""Per key: hash exchanges, join strategies and tables read more than once in
the executed plan, on the logical tables stored as parquet (as a lake holds
them).  An exchange that two consumers share is executed, and counted, once.

usage: python tools/plan_audit.py [--sf DIR] [--no-broadcast] [key-substring ...]
"""
import argparse
import collections
import os
import re
import sys
import tempfile

from pyspark.sql import DataFrame


def executed_plan(df: DataFrame) -> str:
    """The final plan of ``df``, which is run for it: what adaptive execution made of it."""
    query = df._jdf.queryExecution()
    query.toRdd().count()
    kept, first = [], None
    for line in query.executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if first is not None and depth >= first:
            continue  # below "Initial Plan", of the query or of a subquery
        first = depth if "== Initial Plan ==" in line else None
        if first is None:
            kept.append(line)
    return "\n".join(kept)


def scans(plan: str, tables) -> collections.Counter:
    """How often an executed plan reads each of the logical tables."""
    return collections.Counter(t for t in re.findall(r"Location: [^\n]*?/([a-z_]+)\]", plan) if t in set(tables))


def main() -> None:
    sys.path.insert(0, ".")
    from ledgerline import registry
    from ledgerline.params import FIXTURE_PARAMS
    from ledgerline.session import build_session
    from ledgerline.sources.tables import Tables

    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--no-broadcast", action="store_true", help="plan as on a cluster where no side fits a broadcast")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()
    extra = {"spark.sql.maxMetadataStringLength": "100000"}
    if a.no_broadcast:
        extra.update({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    spark = build_session(shuffle_partitions=16, extra=extra)
    root = tempfile.mkdtemp(prefix="plan-audit-", dir=os.environ.get("TMPDIR", "/tmp"))
    tabs = {}
    for v in ("mt", "st"):
        Tables.from_dir(spark, a.sf, v).write(f"{root}/{v}", files=16)
        tabs[v] = Tables.from_parquet(spark, f"{root}/{v}", v)
    for key in registry.queries():
        if a.keys and not any(s in key for s in a.keys):
            continue
        plan, _, var = registry.report(key)
        text = executed_plan(plan(tabs[var.name], FIXTURE_PARAMS, var))
        ex = re.findall(r"(?<!ReusedExchange )Exchange hashpartitioning\(([^)]*?), \d+\)", text)
        joins = collections.Counter(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)", text))
        rep = {t: n for t, n in scans(text, tabs[var.name]).items() if n > 1}
        print(f"{key:34s} exchanges={len(ex):2d} joins={dict(joins)} repeated_scans={rep} expand={text.count('Expand ')}", flush=True)


if __name__ == "__main__":
    main()
