"""Spark session defaults for the reports."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Session settings every report relies on: UTC dates, ANSI semantics,
# adaptive execution (runtime broadcast switch, partition coalescing,
# skew-join splitting).  Several reports chain joins on the same member or
# account key; AQE would not split a skewed partition there because the
# split breaks the partitioning the next join uses, so the split is forced
# (one extra shuffle beats one task holding a third of the rows).
# A task of several joins and sums keeps every row that it reads in several
# sorts and hash tables, some 30 times the compressed bytes, so it reads 16 MB.
REPORT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}
#: Parts that a shuffle is cut into at least, whatever the session's number of shuffle partitions: small ones
#: are put together again, but a part cannot get smaller.
PARTS = 200
INITIAL_PARTS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "ledgerline",
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks (the UI stays off).

    The minimum (1 MB) coalesced partition size is lowered so the small local
    data sets still spread over all cores after AQE coalescing; on a cluster
    keep the default (or raise it) with a large shuffle-partition count.
    """
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g"))
    for k, v in {**REPORT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_report_conf(spark: SparkSession) -> None:
    """Set REPORT_CONF on the caller's session, and at least PARTS initial shuffle partitions.

    The reports rely on these settings; a caller who builds reports on an own
    session calls this first, or ``check_report_conf`` to keep its settings
    and be told where they differ.
    """
    for k, v in REPORT_CONF.items():
        spark.conf.set(k, v)
    spark.conf.set(INITIAL_PARTS, str(max(PARTS, _initial_parts(spark))))


def _initial_parts(spark: SparkSession) -> int:
    """Parts that a shuffle of the session is cut into before small ones are put together; at least its shuffle partitions."""
    named = spark.conf.get("spark.sql.shuffle.partitions")
    return max(int(named), int(spark.conf.get(INITIAL_PARTS, None) or named))


def check_report_conf(spark: SparkSession) -> list[str]:
    """The settings of REPORT_CONF that ``spark`` does not have, as ``name=value``, and PARTS if its shuffles have fewer."""
    differ = [f"{k}={v}" for k, v in REPORT_CONF.items() if (spark.conf.get(k, None) or "").lower() != v.lower()]
    return differ + ([f"{INITIAL_PARTS}={PARTS}"] if _initial_parts(spark) < PARTS else [])
