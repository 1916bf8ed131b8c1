"""Adjacent pairs and their statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.functions.expressions import (
    ids_to_seq,
    pair_left_id,
    pair_right_id,
    pair_strings,
    pairs_expr,
)


def pair_counts(words: DataFrame, seq_col: str = "seq", n_col: str = "n", max_id: int | None = None
                ) -> DataFrame:
    """Weighted adjacent-pair counts of token strings: ``pair, n`` (A1).

    Overlapping occurrences count (``aaa`` has (a,a) twice).  Words shorter
    than two tokens carry no pair (P8).  Partial aggregation runs before the
    shuffle, so the exchange carries at most one row per pair and task.
    """
    pairs = pair_strings(seq_col) if max_id is None else pairs_expr(seq_col, max_id)
    return (
        words.where(F.length(seq_col) >= 2)
        .select(F.explode(pairs).alias("pair"), F.col(n_col).alias("w"))
        .groupBy("pair")
        .agg(F.sum("w").cast("bigint").alias("n"))
    )


def with_ids(pc: DataFrame, pair_col: str = "pair") -> DataFrame:
    """Add ``left, right`` INT ids decoded from the 2-char pair string."""
    return pc.withColumn("left", pair_left_id(pair_col)).withColumn("right", pair_right_id(pair_col))


def pair_counts_of_ids(df: DataFrame, ids_col: str = "ids", weight_col: str | None = None
                       ) -> DataFrame:
    """Pair counts of an ``ARRAY<INT>`` column: ``left, right, n`` (F2 API form, W1).

    Element i is paired with element i+1 (``arrays_zip`` of two slices).
    """
    ids = F.col(ids_col)
    n = F.size(ids)
    zipped = F.arrays_zip(F.slice(ids, 1, F.greatest(n - 1, F.lit(0))).alias("l"),
                          F.slice(ids, 2, F.greatest(n - 1, F.lit(0))).alias("r"))
    w = F.col(weight_col) if weight_col else F.lit(1)
    return (
        df.where(n >= 2)
        .select(F.explode(zipped).alias("z"), w.alias("w"))
        .groupBy(F.col("z.l").cast("int").alias("left"), F.col("z.r").cast("int").alias("right"))
        .agg(F.sum("w").cast("bigint").alias("n"))
    )


def accumulate_counts(prior: DataFrame, more: DataFrame) -> DataFrame:
    """Add a new count table to an existing one (A1b): union + sum."""
    keys = [c for c in prior.columns if c != "n"]
    return (prior.unionByName(more).groupBy(*keys)
            .agg(F.sum("n").cast("bigint").alias("n")))


def pair_index(words: DataFrame, word_id_col: str = "word_id", seq_col: str = "seq") -> DataFrame:
    """Inverted index pair -> words holding it: ``pair, word_id`` (A2)."""
    return (words.where(F.length(seq_col) >= 2)
            .select(F.explode(F.array_distinct(pair_strings(seq_col))).alias("pair"), word_id_col))


def ranked_pairs(pc: DataFrame, vocab_df: DataFrame) -> DataFrame:
    """Pairs with the bytes of both sides, ready to order by the training rank (A3).

    Rank = count desc, left bytes desc, right bytes desc (unsigned, prefix
    smaller), then the smaller (left, right) id pair.  ``vocab_df`` holds at
    most vocab_size rows, so it is broadcast.
    """
    v = F.broadcast(vocab_df.select("id", "bytes"))
    lv = v.select(F.col("id").alias("left"), F.col("bytes").alias("left_bytes"))
    rv = v.select(F.col("id").alias("right"), F.col("bytes").alias("right_bytes"))
    return with_ids(pc).join(lv, "left").join(rv, "right")


def rank_order() -> list:
    return [F.desc("n"), F.desc("left_bytes"), F.desc("right_bytes"), F.asc("left"), F.asc("right")]


def top_pairs(pc: DataFrame, vocab_df: DataFrame, k: int) -> DataFrame:
    """The k best pairs in rank order (O2); a TakeOrderedAndProject, no full sort."""
    return ranked_pairs(pc, vocab_df).orderBy(*rank_order()).limit(k)


def pair_string(left: int, right: int) -> str:
    return ids_to_seq([left, right])
