"""Session helpers: a local session for tests / bench, and checkpoint-dir lookup."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "pairforge") -> SparkSession:
    """A local session with the settings the tests and bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """Directory for reliable checkpoints and intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir`` (or a directory already set on
    the SparkContext).  Only when neither is set *and* the master is local (tests)
    a fresh temporary directory is created; on a cluster that is an error, since a
    machine-local folder would not survive the loss of an executor.  Set
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` there, as ``local_session``
    does: Spark then deletes a checkpoint once nothing refers to it any more.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if configured:
        sc.setCheckpointDir(configured)
        return sc._jsc.sc().getCheckpointDir().get()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    path = tempfile.mkdtemp(prefix="pairforge-ckpt-")
    sc.setCheckpointDir(path)
    return sc._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the checkpoint directory for written intermediate tables."""
    base = checkpoint_dir(spark)
    import uuid
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def spill_table(df, name: str, compression: str | None = None):
    """Write ``df`` as Parquet below the checkpoint folder and read it back.

    Cuts the lineage with a copy that survives the loss of an executor and whose
    columns later readers can prune.
    """
    path = scratch_path(df.sparkSession, name)
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_parallel(df, spark: SparkSession | None = None):
    """Spread an input that cannot be split at read time before CPU-heavy work.

    Spark splits files for at least one task per core by itself; only inputs too
    small or of too few row groups for that come here with fewer partitions.  A plan with a
    shuffle of its own has Spark's partitions already, and asking for their number would run it.
    """
    spark = spark or df.sparkSession
    if df.isStreaming or "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    if df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism:
        return df
    return df.repartition(2 * spark.sparkContext.defaultParallelism)
