"""Totals and reports over encoded tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def token_total(tokens: DataFrame, group: Sequence[str] = (), n_col: str = "n_tokens") -> DataFrame:
    """``group..., n_tokens, n_rows`` (A5, A6 with ``group=['split']``)."""
    return tokens.groupBy(*group).agg(F.sum(n_col).cast("bigint").alias("n_tokens"),
                                      F.count(F.lit(1)).alias("n_rows"))


def train_report(spark: SparkSession, model, seconds: float, n_words: int | None = None,
                 n_pretokens: int | None = None) -> DataFrame:
    """One-row run report (S16): sizes, rounds, how often pairs were counted anew, timing and the longest token."""
    longest = max(model.vocab.items(), key=lambda kv: (len(kv[1]), -kv[0])) if model.vocab else (None, b"")
    rounds = len(model.rounds)
    row = (len(model.vocab), len(model.merges), rounds, sum(r.recount for r in model.rounds), float(seconds),
           float(seconds) / rounds if rounds else 0.0,
           len(model.merges) / rounds if rounds else 0.0,
           longest[0], len(longest[1]), longest[1].hex().upper(), n_words, n_pretokens)
    return spark.createDataFrame([row], "vocab_size INT, merges INT, rounds INT, recounts INT, seconds DOUBLE, "
                                 "seconds_per_round DOUBLE, merges_per_round DOUBLE, longest_id INT, "
                                 "longest_bytes INT, longest_hex STRING, distinct_words BIGINT, "
                                 "pretokens BIGINT")
