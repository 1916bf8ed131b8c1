"""Comparing two training results (U2, U3, Jn6, J5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merges_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Ordered merge lists side by side (U3): full outer join on ``rank``.

    Inputs: ``rank, left_bytes, right_bytes``.  Output: ``rank, a_left, a_right,
    b_left, b_right`` (hex) and ``same`` (null-safe equality of both sides).
    """
    x = a.select("rank", F.hex("left_bytes").alias("a_left"), F.hex("right_bytes").alias("a_right"))
    y = b.select("rank", F.hex("left_bytes").alias("b_left"), F.hex("right_bytes").alias("b_right"))
    j = x.join(y, "rank", "full_outer")
    same = F.col("a_left").eqNullSafe(F.col("b_left")) & F.col("a_right").eqNullSafe(F.col("b_right"))
    return j.withColumn("same", same)


def first_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """The lowest rank where the two merge lists differ (empty when equal)."""
    return merges_diff(a, b).where(~F.col("same")).orderBy("rank").limit(1)


def vocab_set_diff(a: DataFrame, b: DataFrame, col: str = "bytes") -> DataFrame:
    """Values in only one vocabulary (U2): ``side, hex``; empty when the sets agree."""
    x = a.select(F.hex(col).alias("hex")).distinct()
    y = b.select(F.hex(col).alias("hex")).distinct()
    return (x.exceptAll(y).withColumn("side", F.lit("only_a"))
            .unionByName(y.exceptAll(x).withColumn("side", F.lit("only_b"))))


def id_set_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Ids present in only one vocabulary (key-set check of U2)."""
    x = a.select("id")
    y = b.select("id")
    return (x.subtract(y).withColumn("side", F.lit("only_a"))
            .unionByName(y.subtract(x).withColumn("side", F.lit("only_b"))))
