"""Encoding text tables into token ids (E1-E4, E9, E11, S3 unit, A5).

Row-local: the JVM regex cuts each text into words by segment between special
tokens (one evaluation per row), and one Arrow UDF turns the row's words into
ids with the merges as a broadcast variable (at most vocab_size entries).  No
token leaves its row, so there is no shuffle, no skew, and rows need no key:
equal keys stay separate rows.  Where rows are wanted in an order, the texts are dealt by it before they
are encoded, as a text is a fraction of its ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.functions.expressions import (
    specials_in_order,
    split_lines,
    split_on_specials,
)
from pairforge.functions.patterns import java_pretoken_pattern
from pairforge.functions.udfs import make_encode_udf, make_row_udf, make_unpack_udf, packed_type
from pairforge.session import ensure_parallel


BYTES_PER_RANGE = 16 << 20   # text that a task gets where rows are encoded in an order


def _merge_table(model) -> dict[tuple[int, int], tuple[int, int]]:
    return {(a, b): (r, n) for r, (a, b, n) in enumerate(model.merges)}


def _encoder_parts(spark: SparkSession, model):
    """(merges, byte ids or None, id of the unknown token or None); the first two as broadcast variables."""
    sc = spark.sparkContext
    present = {b[0]: i for i, b in model.vocab.items() if model.kinds.get(i) == "byte"}
    if len(present) == 256 and all(present[b] == b for b in range(256)):
        return sc.broadcast(_merge_table(model)), None, None
    unk = model.special_ids().get(model.unk_token) if model.unk_token else None
    return sc.broadcast(_merge_table(model)), sc.broadcast(present), unk


def encoder_udf(spark: SparkSession, model):
    """The word -> ids UDF of a model, with its merges as a broadcast variable."""
    return make_encode_udf(*_encoder_parts(spark, model))


def work_partitions(spark: SparkSession) -> int:
    """Partitions for CPU-heavy per-row work (UDF, pair explosion) on compact tables.

    AQE would coalesce a small distinct-word table into very few partitions;
    CPU-bound work needs at least a couple of tasks per core.
    """
    return max(2 * spark.sparkContext.defaultParallelism,
               int(spark.conf.get("spark.sql.shuffle.partitions")))


def _words_and_specials(text: Column, specials: Sequence[str]) -> tuple[Column, Column]:
    """Words of each segment between special tokens, and those tokens in order; null is an empty text."""
    t = F.coalesce(text, F.lit(""))
    words = F.transform(split_on_specials(t, specials),
                        lambda s: F.regexp_extract_all(s, F.lit(java_pretoken_pattern()), F.lit(0)))
    return words, specials_in_order(t, specials)


def encode_words(spark: SparkSession, words: DataFrame, model, word_col: str = "word") -> DataFrame:
    """Add ``ids ARRAY<INT>`` to a table of distinct words (E1 core).

    The words are spread over ``work_partitions`` tasks first, so the Arrow UDF
    runs on every core instead of the one or two partitions AQE leaves.
    """
    return words.repartition(work_partitions(spark)).withColumn(
        "ids", encoder_udf(spark, model)(F.col(word_col)))


def _units(spark: SparkSession, df: DataFrame, key: Sequence[str], text_col: str, unit: str,
           spread: bool = True) -> tuple[DataFrame, list[str]]:
    df = df.select(*key, text_col)
    if spread:
        df = ensure_parallel(df, spark)
    if unit != "line":
        return df, list(key)
    lines = df.select(*key, F.posexplode(split_lines(text_col)).alias("line_no", text_col))
    return lines, [*key, "line_no"]


def encode(spark: SparkSession, df: DataFrame, model, key: Sequence[str] = ("doc_id",),
           text_col: str = "text", unit: str = "document", skip_empty: bool = False, order: Sequence[str] = (),
           packed: bool = False) -> DataFrame:
    """Encode every row of ``df``: ``key..., [line_no], ids, n_tokens``.

    ``unit='document'`` encodes whole texts (training's view); ``unit='line'``
    encodes text-mode lines, each keeping its LF (the corpus-encoding view).
    ``skip_empty`` drops rows without tokens (P9).  ``key`` are columns to keep;
    they need not be unique.  A null or empty text has no ids.  Rows per Arrow
    batch (E12) are ``spark.sql.execution.arrow.maxRecordsPerBatch``.

    ``order``: columns by whose ranges the rows are dealt to tasks and sorted there; the number of
    ranges follows the bytes of text.  ``packed``: ``ids`` is a BINARY for ``unpack_ids``, which is written and
    read as one value instead of id by id.
    """
    rows, kept = _units(spark, df, key, text_col, unit, spread=not order)
    if order:
        total = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
        ranges = max(2 * spark.sparkContext.defaultParallelism, -(-int(total) // BYTES_PER_RANGE))
        rows = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    kind = packed_type(model.vocab) if packed else None
    udf = make_row_udf(*_encoder_parts(spark, model), model.special_ids(), counts=False, packed=kind)
    ids = udf(*_words_and_specials(F.col(text_col), list(model.special_tokens)))
    size = (F.octet_length("ids") / F.lit(int(kind[-1]))).cast("int") if packed else F.size("ids")
    out = rows.select(*kept, ids.alias("ids")).withColumn("n_tokens", size)
    return out.where(F.col("n_tokens") > 0) if skip_empty else out


def unpack_ids(model, ids_col: str = "ids"):
    """The ids of ``encode(packed=True)`` as ARRAY<INT>."""
    return make_unpack_udf(packed_type(model.vocab))(F.col(ids_col))


def encode_texts(spark: SparkSession, model, texts: Sequence[str]) -> list[list[int]]:
    """E2 convenience: encode a few literal strings (a small DataFrame)."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING")
    rows = {r["doc_id"]: list(r["ids"]) for r in encode(spark, df, model).collect()}
    return [rows.get(i, []) for i in range(len(texts))]


def token_counts(spark: SparkSession, df: DataFrame, model, text_col: str = "text",
                 group: Sequence[str] = ()) -> DataFrame:
    """Token totals without materialising ids (E11, A5): ``group..., n_tokens``.

    One scan: each row is counted where it is read, and only partial sums are shuffled.
    """
    rows, kept = _units(spark, df, group, text_col, "document")
    udf = make_row_udf(*_encoder_parts(spark, model), model.special_ids(), counts=True)
    n = udf(*_words_and_specials(F.col(text_col), list(model.special_tokens)))
    return (rows.select(*kept, n.alias("__n")).groupBy(*kept)
            .agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("n_tokens")))
