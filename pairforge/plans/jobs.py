"""Corpus-level jobs built from the operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.operators.encode import encode, unpack_ids
from pairforge.operators.offsets import token_offsets
from pairforge.operators.stats import token_total


def encode_splits(spark: SparkSession, splits: Mapping[str, DataFrame], model, key=("doc_id",),
                  text_col: str = "text", unit: str = "line") -> DataFrame:
    """Encode several corpora in one plan (S14): ``split, key..., ids, n_tokens, start_pos``.

    The inputs are tagged and unioned; ``start_pos`` restarts at 0 in each split.
    Rows without tokens are skipped, as the binary writers do (P9).  The texts are dealt by range of the
    order and encoded there; the ids are written once, where they are and packed, and positions are made from that copy.
    """
    tagged = None
    for name, df in splits.items():
        t = df.select(F.lit(name).alias("split"), *key, text_col)
        tagged = t if tagged is None else tagged.unionByName(t)
    order = list(key) + (["line_no"] if unit == "line" else [])
    enc = encode(spark, tagged, model, key=("split", *key), text_col=text_col, unit=unit, skip_empty=True, order=["split", *order],
                 packed=True)
    placed = token_offsets(enc, order=order, partition=["split"], in_order=True, compression="zstd")
    return placed.withColumn("ids", unpack_ids(model))


def split_totals(tokens: DataFrame) -> DataFrame:
    """Token and row totals per split."""
    return token_total(tokens, group=["split"])
