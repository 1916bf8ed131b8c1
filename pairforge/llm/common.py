"""Helpers shared by the operators: tables, Arrow batch sizes, materialising, ranks."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.session import checkpoint_dir

#: White space of the contracts: blank, \t, \n, \v, \f, \r.
WS = " \t\n\x0b\x0c\r"

#: Rows per Arrow batch for tables that hold whole texts: keeps a batch at a few MB.
TEXT_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    """Bound Arrow batches for text columns; the default of 10,000 rows is meant for narrow rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def worker_cache() -> dict:
    """A dictionary of the Python worker's process, for models that tasks after this one use again.

    Worker code is pickled by value, so a module's globals are new in every task.
    """
    import sys
    import types

    name = "_pairforge_worker_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def pin(df: DataFrame) -> DataFrame:
    """Materialise once in the shared checkpoint folder (reliable, never ``localCheckpoint``).

    Cuts the lineage; a lost executor costs a reread of files, not a rerun.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, rows: int = TEXT_ROWS):
    """Arrow batches of ``rows`` for the jobs that run inside; the session's own setting comes back after."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def own_session(spark: SparkSession, rows: int) -> SparkSession:
    """A session with the caller's settings but ``rows`` to an Arrow batch, so the caller's stay as they are."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return own


def spill_table(df: DataFrame, name: str, session: SparkSession | None = None) -> DataFrame:
    """Write as Parquet below the shared checkpoint folder and read back, in ``session`` if given.

    Unlike ``checkpoint`` the copy is columnar and compressed, and later
    readers prune its columns.
    """
    spark = session or df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(""))


def global_rank(df: DataFrame, order: list[str], out: str, parts: int) -> DataFrame:
    """Gapless rank from 0 by ``order`` without a one-task window.

    Rows are range-partitioned and numbered inside their partition; the written
    result is counted per partition (one row per partition) and the running sum
    of those counts is joined back.  ``order`` must make rows distinct enough
    for a reproducible sort; the numbering is written once, so a retry cannot
    change it.
    """
    cols = df.columns
    schema = T.StructType([*df.schema, T.StructField("__part", T.IntegerType()), T.StructField("__at", T.LongType())])

    def number(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([part] * n, pa.int32()), pa.array(range(at, at + n), pa.int64())],
                names=[*b.schema.names, "__part", "__at"])
            at += n

    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    done = pin(ranged.mapInArrow(number, schema))
    return done.join(F.broadcast(part_bases(done)), "__part").select(
        *cols, (F.col("__base") + F.col("__at")).alias(out))


def part_bases(numbered: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Rows before each partition: at most partitions x distinct ``by`` rows."""
    from pyspark.sql import Window

    w = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return (numbered.groupBy(*by, "__part").agg(F.count(F.lit(1)).alias("__n"))
            .withColumn("__base", F.coalesce(F.sum("__n").over(w), F.lit(0))).drop("__n"))


def parts_for(spark: SparkSession, rows: int, per_part: int) -> int:
    """Partition count that follows the row count, at least one per core."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // per_part))
