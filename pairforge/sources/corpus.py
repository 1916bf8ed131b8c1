"""Corpus sources: document tables, raw text files, lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.functions.expressions import split_lines, split_on_specials
from pairforge.functions.patterns import DEFAULT_SPECIAL_TOKEN


# The well-formed UTF-8 sequences, over the bytes as ISO-8859-1 characters.
UTF8_SEQUENCE = (r"[\x00-\x7F]|[\xC2-\xDF][\x80-\xBF]|\xE0[\xA0-\xBF][\x80-\xBF]|[\xE1-\xEC\xEE\xEF][\x80-\xBF]{2}|\xED[\x80-\x9F][\x80-\xBF]"
         r"|\xF0[\x90-\xBF][\x80-\xBF]{2}|[\xF1-\xF3][\x80-\xBF]{3}|\xF4[\x80-\x8F][\x80-\xBF]{2}")


def decode_utf8_ignore(raw_binary) -> F.Column:
    """BINARY -> STRING dropping invalid UTF-8 bytes (P3), in one JVM expression.

    A valid row is cast.  In another one each well-formed sequence replaces itself and any other
    byte nothing; a continuation byte starts no sequence, so this drops what a decoder that
    ignores errors drops.  The pattern has no repeated group, so long rows cannot exhaust the stack.
    """
    raw = F.col(raw_binary) if isinstance(raw_binary, str) else raw_binary
    as_text = raw.cast("string")
    kept = F.regexp_replace(F.decode(raw, "ISO-8859-1"), F.lit(f"({UTF8_SEQUENCE})|[\\s\\S]"), F.lit("$1"))
    return F.when(F.is_valid_utf8(as_text), as_text).otherwise(F.encode(kept, "ISO-8859-1").cast("string"))


def _wrap_missing(fn):
    def inner(*a, **k):
        try:
            return fn(*a, **k)
        except AnalysisException as e:  # S6: report missing input clearly
            if "PATH_NOT_FOUND" in str(e):
                raise FileNotFoundError(str(e).splitlines()[0]) from e
            raise
    inner.__doc__ = fn.__doc__
    inner.__name__ = fn.__name__
    return inner


@_wrap_missing
def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_wrap_missing
def read_documents(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Parquet documents (doc_id, text, ...); column pruning/pushdown is Spark's."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)


@_wrap_missing
def read_text_records(spark: SparkSession, paths: str | Sequence[str],
                      delimiter: str = DEFAULT_SPECIAL_TOKEN) -> DataFrame:
    """Delimiter-aligned parallel scan of raw text files.

    Files are cut into input splits whose records end at ``delimiter`` (the
    delimiter itself is dropped), so one large file is read by many tasks and no
    document is cut.  Invalid UTF-8 bytes are dropped (P3).  Columns:
    ``path, record_id, text``; ``record_id`` orders records within the scan.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.option("lineSep", delimiter).text(paths)
    return df.select(
        F.input_file_name().alias("path"),
        F.monotonically_increasing_id().alias("record_id"),
        decode_utf8_ignore(F.col("value").cast("binary")).alias("text"),
    )


@_wrap_missing
def read_text_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per file with its whole decoded text (S1 for small files)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.format("binaryFile").load(paths)
    return df.select(F.col("path"), decode_utf8_ignore("content").alias("text"))


def split_documents(df: DataFrame, text_col: str = "text",
                    special_tokens: Sequence[str] = (DEFAULT_SPECIAL_TOKEN,),
                    keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Documents between special tokens, specials dropped.

    Output: ``keep..., part, text``; ``part`` is the 0-based position inside the
    source row.
    """
    return df.select(*keep, F.posexplode(split_on_specials(text_col, special_tokens))
                     .alias("part", text_col))


def to_lines(df: DataFrame, key: str = "doc_id", text_col: str = "text",
             keep: Sequence[str] = ()) -> DataFrame:
    """Text-mode lines (S3): universal newlines, each line keeps its LF.

    Output: ``key, keep..., line_no (0-based), line``.
    """
    return df.select(key, *keep, F.posexplode(split_lines(text_col)).alias("line_no", "line"))


def line_counts(df: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Number of text-mode lines per row (S5), without exploding."""
    return df.select(key, F.size(split_lines(text_col)).cast("bigint").alias("n_lines"))
