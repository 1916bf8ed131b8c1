"""Vocabulary frames and the printable byte alphabet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.functions.patterns import byte_alphabet

VOCAB_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("bytes", T.BinaryType(), False),
    T.StructField("kind", T.StringType(), False),
])


def initial_vocab(special_tokens: Sequence[str] = (), specials_first: bool = False
                  ) -> tuple[dict[int, bytes], dict[int, str]]:
    """ids 0..255 = bytes, then each special in list order (duplicates keep an id each).

    ``specials_first`` puts the specials at 0.. and shifts the bytes after them
    (the layout of some published vocab files).  Returns ``(vocab, kinds)``.
    """
    vocab: dict[int, bytes] = {}
    kinds: dict[int, str] = {}
    specials = [s.encode("utf-8") for s in special_tokens]
    if specials_first:
        for s in specials:
            kinds[len(vocab)] = "special"
            vocab[len(vocab)] = s
    for b in range(256):
        kinds[len(vocab)] = "byte"
        vocab[len(vocab)] = bytes([b])
    if not specials_first:
        for s in specials:
            kinds[len(vocab)] = "special"
            vocab[len(vocab)] = s
    return vocab, kinds


def byte_vocab_frame(spark: SparkSession) -> DataFrame:
    """The 256 single-byte tokens, generated on the executors (P5)."""
    return spark.range(256).select(
        F.col("id").cast("int").alias("id"),
        F.unhex(F.lpad(F.hex("id"), 2, "0")).alias("bytes"),
        F.lit("byte").alias("kind"),
    )


def vocab_frame(spark: SparkSession, vocab: dict[int, bytes], kinds: dict[int, str] | None = None
                ) -> DataFrame:
    """``vocab(id, bytes, kind)`` from a trained model (at most vocab_size rows)."""
    kinds = kinds or {}
    rows = [(int(i), bytearray(b), kinds.get(i, "merge")) for i, b in sorted(vocab.items())]
    return spark.createDataFrame(rows, VOCAB_SCHEMA)


def _alphabet_strings() -> tuple[str, str]:
    alpha = byte_alphabet()
    return "".join(chr(b) for b in range(256)), "".join(alpha[b] for b in range(256))


def to_alphabet(binary_col) -> Column:
    """BINARY -> printable byte-alphabet string (E6), JVM-side ``translate``."""
    src, dst = _alphabet_strings()
    c = F.col(binary_col) if isinstance(binary_col, str) else binary_col
    return F.translate(F.decode(c, "ISO-8859-1"), src, dst)


def from_alphabet(text_col) -> Column:
    """Byte-alphabet string -> BINARY (E7): the inverse ``translate``.

    ``translate`` reserves U+0000 as its "delete" marker, so the character of
    byte 0 is mapped by a ``replace`` after it.
    """
    src, dst = _alphabet_strings()
    c = F.col(text_col) if isinstance(text_col, str) else text_col
    latin1 = F.replace(F.translate(c, dst[1:], src[1:]), F.lit(dst[0]), F.lit("\x00"))
    return F.encode(latin1, "ISO-8859-1")


def byte_alphabet_frame(spark: SparkSession) -> DataFrame:
    """``byte_alphabet(byte, ch)`` (256 rows) computed from the rule on executors."""
    b = F.col("id").cast("int")
    return spark.range(256).select(b.alias("byte"), to_alphabet(F.unhex(F.lpad(F.hex(b), 2, "0"))).alias("ch"))


def longest_token(vocab_df: DataFrame, by: str = "bytes") -> DataFrame:
    """Longest token, ties to the smallest id.

    ``by='bytes'`` measures the token's bytes; ``by='chars'`` the length of its
    printable byte-alphabet form (the character-length report).
    """
    length = F.octet_length("bytes") if by == "bytes" else F.char_length(to_alphabet("bytes"))
    key = F.struct(length.alias("len"), (-F.col("id")).alias("neg_id"))
    return vocab_df.agg(
        F.max_by("id", key).alias("id"),
        F.max_by(F.octet_length("bytes"), key).alias("n_bytes"),
        F.max_by(F.hex("bytes"), key).alias("hex"),
    )


def vocab_size(vocab_df: DataFrame) -> DataFrame:
    """Row count of the vocabulary."""
    return vocab_df.agg(F.count(F.lit(1)).alias("vocab_size"))
