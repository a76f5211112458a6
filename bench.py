"""Benchmark: run every report key at $BENCH_SF_DIR on local[$BENCH_CPUS].

The 18 logical tables are first bound from the driver's parquet files and
stored as parquet (what a production lake holds; timed as ``bind_seconds``).
Each report then runs against the stored tables to a ``noop`` sink (full
computation, no output I/O): one warm-up pass over all reports (JIT,
codegen caches), then $BENCH_RUNS timed passes (default 3); a report's time
is its best pass and ``value`` is the sum.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline import registry  # noqa: E402
from ledgerline.params import FIXTURE_PARAMS  # noqa: E402
from ledgerline.session import build_session  # noqa: E402
from ledgerline.sources.tables import Tables  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app="ledgerline-bench")
    only = [k for k in sys.argv[1:] if not k.startswith("-")]
    keys = [k for k in registry.queries() if not only or any(s in k for s in only)]

    # Stored tables of this run: $BENCH_STORE (on a cluster, a shared folder) or a folder of their own.
    store = os.environ.get("BENCH_STORE") or tempfile.mkdtemp(prefix="ledgerline-bench-")
    t0 = time.perf_counter()
    tables = {}
    for tenancy in ("mt", "st"):
        root = os.path.join(store, tenancy)
        Tables.from_dir(spark, sf_dir, tenancy).write(root, files=int(cpus) * 2)
        tables[tenancy] = Tables.from_parquet(spark, root, tenancy)
    bind = round(time.perf_counter() - t0, 3)

    def run(key: str) -> None:
        plan, _, v = registry.report(key)
        plan(tables[v.name], FIXTURE_PARAMS, v).write.format("noop").mode("overwrite").save()

    for k in keys:  # warm-up pass
        run(k)
    times: dict[str, float] = {}
    for _ in range(int(os.environ.get("BENCH_RUNS", "3"))):
        for k in keys:
            t1 = time.perf_counter()
            run(k)
            d = round(time.perf_counter() - t1, 3)
            times[k] = min(d, times.get(k, d))
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_report_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus), "bind_seconds": bind}))
    spark.stop()


if __name__ == "__main__":
    main()
