"""Pre-tokenization and word statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.functions.expressions import pretokens, seq_from_word, seq_to_ids
from pairforge.functions.patterns import DEFAULT_SPECIAL_TOKEN
from pairforge.session import ensure_parallel


def pretokenize(df: DataFrame, text_col: str = "text",
                special_tokens: Sequence[str] = (DEFAULT_SPECIAL_TOKEN,),
                keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per pre-token occurrence: ``keep..., pos, word``."""
    return df.select(*keep, F.posexplode(pretokens(text_col, special_tokens)).alias("pos", "word"))


def word_counts(df: DataFrame, text_col: str = "text",
                special_tokens: Sequence[str] = (DEFAULT_SPECIAL_TOKEN,),
                group: Sequence[str] = ()) -> DataFrame:
    """Distinct pre-tokens with their frequency: ``group..., word, n`` (A4).

    This is the compaction that makes training scale: a partial hash aggregate
    runs before the shuffle, so a hot word (" the") is pre-summed per task and
    never concentrates raw occurrences in one reducer.
    """
    words = ensure_parallel(df.select(*group, text_col)).select(
        *group, F.explode(pretokens(text_col, special_tokens)).alias("word"))
    return words.groupBy(*group, "word").agg(F.count(F.lit(1)).alias("n"))


def training_words(word_df: DataFrame, word_col: str = "word", n_col: str = "n") -> DataFrame:
    """Word table for training: ``seq`` = token string of the UTF-8 bytes."""
    return word_df.select(seq_from_word(word_col).alias("seq"), F.col(n_col).cast("bigint").alias("n"))


def pretokens_per_document(df: DataFrame, key: str = "doc_id", text_col: str = "text",
                           special_tokens: Sequence[str] = (DEFAULT_SPECIAL_TOKEN,)) -> DataFrame:
    """Pre-token count per row (A9), computed without exploding."""
    return df.select(key, F.size(pretokens(text_col, special_tokens)).cast("bigint").alias("n_pretokens"))


def byte_histogram(word_df: DataFrame, word_col: str = "word", n_col: str = "n") -> DataFrame:
    """Occurrences of each UTF-8 byte value in the pre-tokens: ``byte, n``.

    Works on the compacted word table, so each distinct word is expanded once and
    weighted by its frequency instead of exploding every byte of the corpus.
    """
    ids = seq_to_ids(seq_from_word(word_col))
    return (word_df.select(F.explode(ids).alias("byte"), F.col(n_col).alias("w"))
            .groupBy("byte").agg(F.sum("w").cast("bigint").alias("n")))
