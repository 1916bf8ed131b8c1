"""Applying merges and maintaining pair counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.functions.expressions import id_to_char, ids_to_seq, pair_strings, seq_to_ids

Merge = tuple[int, int, int]  # (left_id, right_id, new_id)


def merge_expr(seq, merges: Sequence[Merge]) -> Column:
    """Apply merges in order to a token string (M1): nested ``replace`` calls.

    ``replace`` scans left to right and never overlaps, which is exactly the
    merge rule (``aaa`` with (a,a) -> ``X a``).
    """
    c = F.col(seq) if isinstance(seq, str) else seq
    for left, right, new in merges:
        c = F.replace(c, F.lit(ids_to_seq([left, right])), F.lit(id_to_char(new)))
    return c


def contains_any(seq, merges: Sequence[Merge]) -> Column:
    """True when the token string holds one of the merge pairs (P10)."""
    c = F.col(seq) if isinstance(seq, str) else seq
    cond = F.lit(False)
    for left, right, _ in merges:
        cond = cond | F.contains(c, F.lit(ids_to_seq([left, right])))
    return cond


def apply_merges(words: DataFrame, merges: Sequence[Merge], seq_col: str = "seq") -> DataFrame:
    """M2: merge every row of a word table."""
    return words.withColumn(seq_col, merge_expr(seq_col, merges))


def affected_words(words: DataFrame, merges: Sequence[Merge], seq_col: str = "seq") -> DataFrame:
    """Only the rows holding one of the pairs (P10)."""
    return words.where(contains_any(seq_col, merges))


def apply_merges_to_ids(df: DataFrame, merges: Sequence[Merge], ids_col: str = "ids") -> DataFrame:
    """F3 API: merge an ``ARRAY<INT>`` column (ids -> token string -> replace -> ids)."""
    return df.withColumn(ids_col, seq_to_ids(merge_expr(ids_to_seq_col(ids_col), merges)))


def ids_to_seq_col(ids) -> Column:
    """ARRAY<INT> -> token string, as one UTF-16BE decode (surrogate pairs built here)."""
    c = F.col(ids) if isinstance(ids, str) else ids

    def utf16_hex(i):
        cp = F.when(i >= 0xD800, i + 0x800).otherwise(i)
        off = cp - 0x10000
        pair = F.concat(F.lpad(F.hex(F.lit(0xD800) + F.shiftright(off, 10)), 4, "0"),
                        F.lpad(F.hex(F.lit(0xDC00) + off.bitwiseAND(F.lit(0x3FF))), 4, "0"))
        return F.when(cp < 0x10000, F.lpad(F.hex(cp), 4, "0")).otherwise(pair)

    return F.decode(F.unhex(F.array_join(F.transform(c, utf16_hex), "")), "UTF-16BE")


def delta_counts(words: DataFrame, merges: Sequence[Merge], seq_col: str = "seq",
                 n_col: str = "n") -> DataFrame:
    """Pair-count change caused by ``merges`` (M3): ``pair, n`` with signed n.

    Only affected words are expanded: their old pairs count -n, their merged
    pairs +n.  Summed per pair before the shuffle.
    """
    hit = affected_words(words, merges, seq_col).select(
        F.col(seq_col).alias("old"), merge_expr(seq_col, merges).alias("new"), F.col(n_col).alias("w"))
    old = hit.select(F.explode(pair_strings("old")).alias("pair"), (-F.col("w")).alias("w"))
    new = hit.select(F.explode(pair_strings("new")).alias("pair"), F.col("w"))
    return (old.unionByName(new).groupBy("pair")
            .agg(F.sum("w").cast("bigint").alias("n")).where(F.col("n") != 0))


def update_counts(counts: DataFrame, delta: DataFrame) -> DataFrame:
    """counts + delta, pairs reaching zero dropped."""
    return (counts.select("pair", "n").unionByName(delta.select("pair", "n"))
            .groupBy("pair").agg(F.sum("n").cast("bigint").alias("n"))
            .where(F.col("n") > 0))


def step_deltas(words: DataFrame, steps: Sequence[Merge], max_id: int, seq_col: str = "seq",
                n_col: str = "n") -> DataFrame:
    """Exact pair-count change of each step of a merge sequence (M3, per step).

    Output ``step, pair, n``: applying ``steps[step-1]`` after the earlier steps
    changes the count of ``pair`` by ``n``.  Only words holding one of the
    pairs are expanded; each intermediate state is one projection (a
    ``replace`` is never recomputed), and pairs unchanged by a step cancel in
    the aggregate.
    """
    from pairforge.functions.expressions import pairs_expr

    hit = affected_words(words, steps, seq_col).select(F.col(seq_col).alias("s0"), F.col(n_col).alias("w"))
    for j, m in enumerate(steps, 1):
        hit = hit.withColumn(f"s{j}", merge_expr(f"s{j - 1}", [m]))
    trans = F.array(*[F.struct(F.lit(j).alias("step"), F.col(f"s{j - 1}").alias("old"),
                               F.col(f"s{j}").alias("new")) for j in range(1, len(steps) + 1)])
    x = hit.select(F.explode(trans).alias("t"), "w").where(F.col("t.old") != F.col("t.new"))
    signed = F.concat(
        F.transform(pairs_expr("t.old", max_id), lambda p: F.struct(p.alias("pair"), F.lit(-1).alias("sign"))),
        F.transform(pairs_expr("t.new", max_id), lambda p: F.struct(p.alias("pair"), F.lit(1).alias("sign"))))
    y = x.select(F.col("t.step").alias("step"), F.explode(signed).alias("e"), "w")
    return (y.groupBy("step", F.col("e.pair").alias("pair"))
            .agg(F.sum(F.col("e.sign") * F.col("w")).cast("bigint").alias("n"))
            .where(F.col("n") != 0))
