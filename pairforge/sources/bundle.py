"""Tokenizer bundle and text artefacts.

A bundle is a directory: ``vocab/`` and ``merges/`` parquet (lossless bytes)
plus ``config/`` (one JSON line with the special tokens).  Text artefacts use
the printable byte alphabet, which is lossless; the "lossy" forms decode bytes
as UTF-8 dropping invalid bytes.  Writers create their directories (S15).
Everything written here holds at most vocab_size rows.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairforge.operators.vocab import from_alphabet, to_alphabet
from pairforge.plans.train import BpeModel
from pairforge.sources.corpus import decode_utf8_ignore


def save_model(spark: SparkSession, model: BpeModel, path: str, mode: str = "overwrite") -> None:
    """Persist a model bundle."""
    model.vocab_df(spark).write.mode(mode).parquet(f"{path}/vocab")
    model.merges_df(spark).write.mode(mode).parquet(f"{path}/merges")
    cfg = json.dumps({"special_tokens": list(model.special_tokens), "unk_token": model.unk_token, "format": 1})
    spark.createDataFrame([(cfg,)], "value STRING").coalesce(1).write.mode(mode).text(f"{path}/config")


def load_model(spark: SparkSession, path: str) -> BpeModel:
    """Restore a bundle (S11); the model is bounded by its vocab size."""
    vrows = spark.read.parquet(f"{path}/vocab").collect()
    mrows = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
    cfg = json.loads(spark.read.text(f"{path}/config").first()["value"])
    vocab = {int(r["id"]): bytes(r["bytes"]) for r in vrows}
    kinds = {int(r["id"]): r["kind"] for r in vrows}
    merges = [(int(r["left_id"]), int(r["right_id"]), int(r["new_id"])) for r in mrows]
    return BpeModel(vocab, kinds, merges, tuple(cfg.get("special_tokens", ())), unk_token=cfg.get("unk_token"))


def merges_lines(merges_df: DataFrame, lossy: bool = False) -> DataFrame:
    """``rank, line`` with ``left right`` per merge."""
    if lossy:
        left, right = decode_utf8_ignore("left_bytes"), decode_utf8_ignore("right_bytes")
    else:
        left, right = to_alphabet("left_bytes"), to_alphabet("right_bytes")
    return merges_df.select("rank", F.concat_ws(" ", left, right).alias("line"))


def write_merges_text(merges_df: DataFrame, path: str, lossy: bool = False) -> None:
    """One text file, merges in rank order."""
    (merges_lines(merges_df, lossy).repartition(1).sortWithinPartitions("rank").select("line")
     .write.mode("overwrite").text(path))


def vocab_json(vocab_df: DataFrame, form: str = "token_to_id") -> DataFrame:
    """One-row JSON object of the vocabulary.

    ``token_to_id`` (S7b): byte-alphabet token -> id.  ``id_to_text`` (S7): id ->
    UTF-8 text with undecodable bytes dropped (lossy, as some exporters do).
    Ids that share their bytes (special tokens listed twice) have one entry in
    ``token_to_id``, for the smallest id; encoding never gives the others.
    """
    if form == "token_to_id":
        vocab_df = vocab_df.groupBy("bytes").agg(F.min("id").alias("id"))
    if form == "token_to_id":
        entries = F.struct(to_alphabet("bytes").alias("k"), F.col("id").alias("v"))
    else:
        entries = F.struct(F.col("id").cast("string").alias("k"), decode_utf8_ignore("bytes").alias("v"))
    return vocab_df.select(entries.alias("e")).agg(
        F.to_json(F.map_from_entries(F.sort_array(F.collect_list("e")))).alias("value"))


def write_vocab_json(vocab_df: DataFrame, path: str, form: str = "token_to_id") -> None:
    vocab_json(vocab_df, form).coalesce(1).write.mode("overwrite").text(path)


def read_vocab_json(spark: SparkSession, path: str) -> DataFrame:
    """Byte-alphabet ``token -> id`` JSON (S9) -> ``id, bytes``."""
    raw = spark.read.text(path, wholetext=True)
    m = F.from_json("value", "map<string,int>")
    return raw.select(F.explode(m).alias("tok", "id")).select(
        F.col("id").cast("int").alias("id"), from_alphabet("tok").alias("bytes"))


def read_merges_text(spark: SparkSession, path: str) -> DataFrame:
    """Byte-alphabet merges file (S9) -> ``rank, left_bytes, right_bytes``.

    Line order is the rank: lines are numbered by (file name, position in the
    file), so several files are one list in the order of their names.  A merge
    list has at most vocab_size lines, so one window over them is bounded.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"),
                                       F.col("_metadata.file_block_start").alias("_block"))
    raw = raw.withColumn("_o", F.monotonically_increasing_id()).where(F.length(F.rtrim("value")) > 0)
    parts = F.split(F.rtrim("value"), " ")
    return raw.select(
        (F.row_number().over(Window.orderBy("_file", "_block", "_o")) - 1).cast("int").alias("rank"),
        from_alphabet(parts[0]).alias("left_bytes"), from_alphabet(parts[1]).alias("right_bytes"))


def model_from_text(spark: SparkSession, vocab_path: str, merges_path: str,
                    special_tokens=()) -> BpeModel:
    """Build a model from exported text files (byte alphabet)."""
    v = {int(r["id"]): bytes(r["bytes"]) for r in read_vocab_json(spark, vocab_path).collect()}
    by_bytes: dict[bytes, int] = {}
    for i in sorted(v):
        by_bytes.setdefault(v[i], i)
    specials = {s.encode("utf-8") for s in special_tokens}
    kinds = {i: "special" if b in specials else ("byte" if len(b) == 1 else "merge") for i, b in v.items()}
    merges = []
    for r in read_merges_text(spark, merges_path).orderBy("rank").collect():
        a, b = bytes(r["left_bytes"]), bytes(r["right_bytes"])
        merges.append((by_bytes[a], by_bytes[b], by_bytes[a + b]))
    return BpeModel(v, kinds, merges, tuple(special_tokens))
