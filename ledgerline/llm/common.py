"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: blank and the control characters 9 to 13.
ASCII_SPACE = " \t\n\x0b\x0c\r"
#: A word of the contracts, as a Java regular expression.
WORD = r"[^\x20\x09-\x0D]+"
#: Copies of one counted row that are made from one array.
CHUNK = 10_000
#: Session setting: a query's shuffle files go when it ends, not when the driver next collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Session setting, and its most: bytes of a batch that goes to a Python worker (10,000 rows of text are ten times as
#: many, held in the executor's buffers and in the worker).
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    own = tempfile.mkdtemp(prefix="ledgerline-")
    sc.setCheckpointDir(own)
    return own


class Scratch:
    """Tables of one operator run, written to the shared folder.

    A written table cuts the lineage: a lost executor costs a re-read of its
    files, never the steps before them.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.made = 0

    def path(self, name: str) -> str:
        self.made += 1
        return f"{self.root}/{self.made:03d}-{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return the written table.

        The shuffles of the write end with it, as all later steps read the
        table: disk holds the shuffles of one step, not those of all steps.
        """
        to = self.path(name)
        before = self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(to)
        finally:
            self.spark.conf.unset(CLEANUP) if before is None else self.spark.conf.set(CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(to)
        out._written = to
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete written tables that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        for t in tables:
            p = jvm.org.apache.hadoop.fs.Path(t._written)
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def small_batches(spark: SparkSession) -> None:
    """Batches to Python workers of at most ``BATCH_BYTES`` from now on; a smaller number of the session stays."""
    jvm = spark.sparkContext._jvm
    named = spark.conf.get(BATCH, None)
    now = jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(named) if named and not named.startswith("-") else 0
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(BATCH, str(BATCH_BYTES))


def map_batches(df: DataFrame, schema: str, fn: Callable[[Iterator[dict]], Iterator[dict]]) -> DataFrame:
    """``mapInArrow`` over column dictionaries: ``fn`` gets and yields {name: pyarrow array or list}.

    Batches are small, and a worker gives Arrow's memory back when its task
    ends: idle workers are kept, and an executor has one for every task and
    Python step of a stage.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in fn({n: b.column(i) for i, n in enumerate(b.schema.names)} for b in batches):
            cols = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                    for f in arrow for c in [out[f.name]]]
            yield pa.RecordBatch.from_arrays(cols, schema=arrow)
        pa.default_memory_pool().release_unused()

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null ids: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Training rows (doc_id, text, _label): documents with a label of 0 or 1, one label per id.

    ``labels`` is reduced to one row per id first (repeated rows: the largest
    label), so that a repeated label does not repeat a document.  Labels grow
    with the documents, so the join is a shuffle join at every size.
    """
    one = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
           .groupBy("doc_id").agg(F.max(label).cast("int").alias("_label")))
    return docs.select("doc_id", "text").join(one.hint("merge"), "doc_id")


def hash_sample(rows: DataFrame, total: int, wanted: int, by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """About ``wanted`` of ``total`` rows (all, if there are no more), by a hash of the columns ``by``; no shuffle.

    Rows alike in ``by`` are drawn together.
    """
    draw = F.pmod(F.xxhash64(F.lit("sample"), *by), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.where(draw * F.lit(total) < F.lit(wanted))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def columns(df: DataFrame, but: tuple[str, ...] = ()) -> list[Column]:
    """The columns of ``df``, whatever their names hold, without those in ``but``."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c not in but]


def numbered(rows: DataFrame, times: str, name: str) -> DataFrame:
    """Every row as often as its column ``times`` (1 or more) says, numbered from 0 in a new column ``name``.

    The copies are numbered in chunks of ``CHUNK`` first, the chunks are dealt
    to tasks by a hash, and the copies are made where their chunk lies: no
    array or task holds all copies of a row, and copies are not shuffled.
    """
    one, size = F.lit(1).cast("long"), F.lit(CHUNK).cast("long")
    chunk = fresh(rows, "_chunk")
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # named, or few chunk rows are put into one task again
    dealt = (rows.withColumn(chunk, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - one) / size))))
             .repartition(tasks, F.xxhash64(*columns(rows), chunk)))
    low = F.col(chunk) * size
    return dealt.withColumn(name, F.explode(F.sequence(low, F.least(low + size, F.col(times)) - one))).drop(chunk)
