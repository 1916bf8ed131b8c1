"""Incremental corpus encoding and word statistics with Structured Streaming.

* T1/T2: encoding is row-local, so each micro-batch is one projection; inside
  ``foreachBatch`` it is written to ``{out}/batch_id={id}`` in overwrite mode, so a
  replayed batch after a failure or restart replaces its own output: exactly-once
  with the checkpoint.
* T1/T2 into the binary form: ``start_shard_encode`` encodes and streams into ``uint16`` shards, exactly once
  (``pairforge.sources.shards``).
* T3: the running total per split is stream state (``start_stream_totals``): each batch adds to it and
  writes the splits it changed; the totals of the last batch are the totals, without a rescan.
  ``stream_totals`` is the query over what the first form wrote.
* T4: progress is Spark's own ``StreamingQueryProgress``.
* T5: streaming word counts (stateful ``groupBy(word).count()`` in update mode):
  each batch writes only the words it changed, under its ``batch_id``;
  ``latest_word_counts`` reads the last value of each word.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.functions.expressions import pretokens
from pairforge.functions.patterns import DEFAULT_SPECIAL_TOKEN
from pairforge.operators.encode import encode


def document_stream(spark: SparkSession, path: str, schema: str, glob: str | None = None,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet directory (or one file pattern in it), or a single file, as a stream of documents.

    A stream's source is a folder, so a path that is a file is taken from its folder by name.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if glob is None and fs.exists(at) and fs.getFileStatus(at).isFile():
        path, glob = at.getParent().toString(), re.sub(r"([\\*?\[\]{}])", r"\\\1", at.getName())
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def start_stream_encode(stream: DataFrame, model, out: str, checkpoint: str, key=("doc_id",),
                        text_col: str = "text", unit: str = "line", available_now: bool = True):
    """Start the incremental encoder (T1, T2); returns the StreamingQuery."""
    spark = stream.sparkSession

    def batch(df: DataFrame, batch_id: int) -> None:
        enc = encode(spark, df, model, key=key, text_col=text_col, unit=unit, skip_empty=True)
        enc = enc.observe(f"tokens_{batch_id}", F.sum("n_tokens").alias("tokens"))
        enc.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def stream_totals(spark: SparkSession, out: str) -> DataFrame:
    """Running total written so far (T3): ``n_tokens, n_rows, batches``."""
    df = spark.read.parquet(out)
    return df.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).cast("bigint").alias("n_tokens"),
                  F.count(F.lit(1)).alias("n_rows"), F.countDistinct("batch_id").alias("batches"))


def start_shard_encode(stream: DataFrame, model, path: str, checkpoint: str, split, text_col: str = "text",
                       unit: str = "line", available_now: bool = True):
    """Encode a document stream into binary shards by split (S12, T1, T2); ``split`` is a column expression."""
    from pairforge.sources.shards import start_token_stream

    rows = stream.select(split.alias("split"), text_col)
    tokens = encode(stream.sparkSession, rows, model, key=("split",), text_col=text_col, unit=unit)
    return start_token_stream(tokens, path, checkpoint, available_now)


def start_stream_totals(stream: DataFrame, model, out: str, checkpoint: str, split, text_col: str = "text",
                        unit: str = "line", available_now: bool = True):
    """Running totals per split as keyed state (T3, W2): ``split, n_tokens, n_rows, next_pos``.

    The state is one row a split; partial sums are made before the shuffle, so a split that holds
    all rows is one row a task.  Each batch writes its changed splits under its ``batch_id``.
    """
    rows = stream.select(split.alias("split"), text_col)
    tokens = encode(stream.sparkSession, rows, model, key=("split",), text_col=text_col, unit=unit, skip_empty=True)
    totals = tokens.groupBy("split").agg(F.sum("n_tokens").cast("bigint").alias("n_tokens"), F.count(F.lit(1)).alias("n_rows"))

    def changes(df: DataFrame, batch_id: int) -> None:
        df.withColumn("next_pos", F.col("n_tokens")).coalesce(1).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    w = totals.writeStream.outputMode("update").foreachBatch(changes).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()


def latest_totals(spark: SparkSession, out: str) -> DataFrame:
    """``split, n_tokens, n_rows, next_pos`` after the last batch that changed a split."""
    last = F.max_by(F.struct("n_tokens", "n_rows", "next_pos"), "batch_id").alias("t")
    return spark.read.parquet(out).groupBy("split").agg(last).select("split", "t.*")


def start_word_counts(stream: DataFrame, out: str, checkpoint: str, text_col: str = "text",
                      special_tokens=(DEFAULT_SPECIAL_TOKEN,), available_now: bool = True, compact_every: int = 16):
    """Maintained word counts (T5): stateful aggregate; the changed words of each batch are written.

    Every ``compact_every`` batches (0: never) they are folded into a snapshot, so reading the
    counts costs the vocabulary and that many batches, however long the stream runs.
    """
    counts = (stream.select(F.explode(pretokens(text_col, special_tokens)).alias("word"))
              .groupBy("word").count().withColumnRenamed("count", "n"))

    def changes(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact_word_counts(df.sparkSession, out, batch_id)

    w = counts.writeStream.outputMode("update").foreachBatch(changes).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def _snapshot(spark: SparkSession, out: str) -> tuple[int, str | None]:
    """(last batch in the snapshot, its path) by the pointer file; (-1, None) before the first."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    pointer = jvm.org.apache.hadoop.fs.Path(f"{out}/_snapshot/pointer.json")
    if not pointer.getFileSystem(conf).exists(pointer):
        return -1, None
    row = spark.read.schema("batch BIGINT, path STRING").json(f"{out}/_snapshot/pointer.json").first()
    return row["batch"], row["path"]


def compact_word_counts(spark: SparkSession, out: str, batch: int) -> None:
    """Fold the batches up to ``batch`` into a snapshot and remove them (T5).

    The snapshot is written beside the old one and a pointer file is replaced by a rename, so a
    reader sees the old state or the new one; folded batches and the old snapshot go after that.
    A failure in between leaves folders that no reader opens and the next call removes.
    """
    import json
    import uuid

    last, old = _snapshot(spark, out)
    if batch <= last:
        return
    path = f"{out}/_snapshot/{batch}-{uuid.uuid4().hex[:8]}"
    _word_counts(spark, out, batch).write.parquet(path)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    base = hadoop.Path(out)
    fs = base.getFileSystem(conf)
    new, pointer = hadoop.Path(f"{out}/_snapshot/pointer-{uuid.uuid4().hex}.json"), hadoop.Path(f"{out}/_snapshot/pointer.json")
    stream = fs.create(new)
    stream.write(bytearray(json.dumps({"batch": batch, "path": path}).encode()))
    stream.close()
    hadoop.FileContext.getFileContext(fs.getUri(), conf).rename(new, pointer, _overwrite(spark))
    for status in fs.listStatus(base):
        name = status.getPath().getName()
        if name.startswith("batch_id=") and int(name[9:]) <= batch:
            fs.delete(status.getPath(), True)
    if old:
        fs.delete(hadoop.Path(old), True)


def _overwrite(spark: SparkSession):
    jvm = spark.sparkContext._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.valueOf("OVERWRITE")
    return options


def _word_counts(spark: SparkSession, out: str, upto: int | None = None) -> DataFrame:
    last, path = _snapshot(spark, out)
    log = None
    try:
        log = spark.read.option("basePath", out).schema("word STRING, n BIGINT, batch_id BIGINT").parquet(f"{out}/batch_id=*").where(F.col("batch_id") > last)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) or path is None:
            raise
    if log is not None and upto is not None:
        log = log.where(F.col("batch_id") <= upto)
    rows = log.select("word", "n", "batch_id") if log is not None else None
    if path is not None:
        kept = spark.read.schema("word STRING, n BIGINT").parquet(path).withColumn("batch_id", F.lit(-1).cast("bigint"))
        rows = kept if rows is None else rows.unionByName(kept)
    return rows.groupBy("word").agg(F.max_by("n", "batch_id").alias("n"))


def latest_word_counts(spark: SparkSession, out: str) -> DataFrame:
    """``word, n`` after the last written batch: the snapshot and the batches since."""
    return _word_counts(spark, out)
