"""Decoding ids back to text.

The id -> bytes table (at most vocab_size entries) travels as one JSON string
literal that Catalyst constant-folds into an ``array<string>`` of hex; each row
is decoded with ``transform`` + ``array_join`` + ``unhex`` inside whole-stage
codegen, with no explode, join or shuffle.  Invalid UTF-8 in the joined bytes
becomes U+FFFD (``make_valid_utf8``), as a byte-level decoder does.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.functions.patterns import byte_alphabet

MAX_LITERAL_VOCAB = 1 << 20


def _table(model, skip_special_tokens: bool, fmt) -> Column:
    size = max(model.vocab) + 1 if model.vocab else 0
    if size > MAX_LITERAL_VOCAB:
        raise ValueError(f"vocabulary of {size} ids exceeds the literal table bound")
    table = [None] * size
    for i, b in model.vocab.items():
        if skip_special_tokens and model.kinds.get(i) == "special":
            continue
        table[i] = fmt(b)
    return F.from_json(F.lit(json.dumps(table)), "array<string>")


def decode_bytes(ids, model, skip_special_tokens: bool = False) -> Column:
    """ARRAY<INT> -> BINARY (concatenated token bytes); unknown ids are skipped."""
    c = F.col(ids) if isinstance(ids, str) else ids
    table = _table(model, skip_special_tokens, lambda b: b.hex().upper())
    return F.unhex(F.array_join(F.transform(c, lambda i: F.get(table, i)), ""))


def decode_text(ids, model, skip_special_tokens: bool = False) -> Column:
    """ARRAY<INT> -> STRING (E5)."""
    return F.make_valid_utf8(decode_bytes(ids, model, skip_special_tokens).cast("string"))


def token_strings(ids, model) -> Column:
    """ARRAY<INT> -> ARRAY<STRING> in the printable byte alphabet (E3, ``.tokens``)."""
    alpha = byte_alphabet()
    c = F.col(ids) if isinstance(ids, str) else ids
    table = _table(model, False, lambda b: "".join(alpha[x] for x in b))
    return F.transform(c, lambda i: F.get(table, i))


def decode(df: DataFrame, model, ids_col: str = "ids", out_col: str = "decoded",
           skip_special_tokens: bool = False) -> DataFrame:
    return df.withColumn(out_col, decode_text(ids_col, model, skip_special_tokens))


def roundtrip_violations(encoded: DataFrame, original: DataFrame, model, key="doc_id",
                         text_col: str = "text") -> DataFrame:
    """Rows where decode(encode(text)) differs from text (E10); empty when exact."""
    dec = decode(encoded, model, "ids", "decoded")
    return (original.select(key, text_col).join(dec.select(key, "decoded"), key, "left")
            .where(~F.col(text_col).eqNullSafe(F.coalesce("decoded", F.lit("")))))
