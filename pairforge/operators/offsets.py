"""Write positions of token rows in a contiguous stream.

``start_pos`` = tokens of all earlier rows in ``order`` (per stream ``partition``
such as the train/val split).  No one-task window and no second run of the input:

1. the rows are written once below the checkpoint folder (the input may be an encode),
2. that table is range-partitioned by the full order, so rows that share their
   leading key are still spread, sorted, and summed up inside each task,
3. only the first stream of a task can continue one from an earlier task; its base
   is a running sum over at most one row per task and stream end.

Rows that come in ranges of the order already, sorted inside each task (``encode(order=...)``), go straight to
the sums: they are written once and not shuffled.

Order and partition keys may be of any orderable type and may be null (nulls first).  Tasks tell
streams apart by a text that is equal where Spark's grouping is: one NaN, one zero.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.session import spill_table

TOKENS_PER_RANGE = 16 << 20


PLACE = T.StructType([T.StructField("_task", T.IntegerType()), T.StructField("_in", T.LongType()), T.StructField("_first", T.BooleanType())])


def _running():
    """(token count, keys...) of a task's rows in order -> task, exclusive sum in the stream, first-stream flag.

    Spark keeps the other columns; only counts and keys go through Python.
    """

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        import numpy as np
        from pyspark import TaskContext

        task, before, held, first = TaskContext.get().partitionId(), 0, None, True
        for columns in batches:
            counts, *keys = [columns] if isinstance(columns, pa.Array) else columns  # one column comes by itself
            n = np.asarray(counts.fill_null(0), "int64")
            if len(n):
                new = np.zeros(len(n), bool)  # a row that starts a stream
                for i, k in enumerate(keys):
                    codes = np.asarray(k.dictionary_encode(null_encoding="encode").indices, "int64")
                    new[1:] |= codes[1:] != codes[:-1]
                    new[0] |= held is not None and held[i] != k[0].as_py()
                held = [k[len(n) - 1].as_py() for k in keys]
                ends = np.cumsum(n)
                starts = np.flatnonzero(new)
                stream = np.cumsum(new)
                base = np.concatenate([[-before], (ends - n)[starts]])[stream]
                out = ends - n - base
                before = int(out[-1] + n[-1])
                is_first = (stream == 0) & first
                first = bool(is_first[-1])
            else:
                out, is_first = n, np.zeros(0, bool)
            yield pa.StructArray.from_arrays([pa.array(np.full(len(n), task, "int32")), pa.array(out), pa.array(is_first)],
                                             names=["_task", "_in", "_first"])

    return F.arrow_udf(run, PLACE).asNondeterministic()


def _identity(field: T.StructField):
    """A column whose equality in a task is Spark's equality of the key."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return F.when(F.isnan(c), F.lit("NaN")).otherwise((c + F.lit(0.0)).cast("string"))
    if isinstance(field.dataType, (T.StructType, T.ArrayType)):
        return F.to_json(F.struct(c))
    return c


def token_offsets(df: DataFrame, order: Sequence[str] = ("doc_id",), n_col: str = "n_tokens",
                  partition: Sequence[str] = (), buckets: int | None = None, in_order: bool = False,
                  compression: str | None = None) -> DataFrame:
    """Add ``start_pos BIGINT`` (exclusive running sum of ``n_col``).

    ``buckets``: number of ranges; by default it follows the token total.  Rows that
    agree on the whole order get positions in the order in which they were sorted.

    ``in_order``: the tasks hold the rows in ranges of ``partition`` and ``order`` and sorted by them.
    ``compression``: that of the written copy, if not the session's.
    """
    order, partition = list(order), list(partition)
    spark = df.sparkSession
    rows = df if in_order else spill_table(df, "offset-input")
    ids = [f"_k{i}" for i in range(len(partition))]
    ranged = rows.select("*", *(_identity(rows.schema[p]).alias(k) for p, k in zip(partition, ids)))
    if not in_order:
        if buckets is None:
            total = rows.agg(F.sum(n_col)).first()[0] or 0
            buckets = max(spark.sparkContext.defaultParallelism, -(-int(total) // TOKENS_PER_RANGE))
        by = [*partition, *order]
        ranged = ranged.repartitionByRange(max(1, buckets), *by).sortWithinPartitions(*by)
    place = _running()(F.col(n_col).cast("bigint"), *(F.col(i) for i in ids)).alias("_p")
    spill = partial(spill_table, compression=compression) if compression else spill_table
    placed = spill(ranged.select(*rows.columns, place).select(*rows.columns, "_p.*"), "offset-ranges")
    totals = placed.groupBy("_task", *partition).agg(F.sum(n_col).alias("_n"), F.max("_first").alias("_first"))
    earlier = Window.partitionBy(*partition).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    bases = (totals.withColumn("_base", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).where("_first")
             .select(F.col("_task").alias("_t"), "_base"))  # one row per task
    out = placed.join(F.broadcast(bases), F.col("_first") & (F.col("_task") == F.col("_t")), "left")
    return out.withColumn("start_pos", (F.col("_in") + F.coalesce("_base", F.lit(0))).cast("bigint")).drop(
        "_task", "_in", "_first", "_t", "_base")
