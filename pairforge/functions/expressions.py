"""Column expressions shared by the operators (all JVM-side, codegen friendly).

Training works on *token strings*: a STRING whose code points are token ids.
Byte b starts as code point b (ISO-8859-1 decode of the UTF-8 bytes); ids at or
above 0xD800 are shifted by 0x800 so no surrogate code point is ever produced.
A pair is then a 2-character substring and applying a merge is ``replace``,
which scans left to right and never overlaps (``replace('aaa','aa','X')='Xa'``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairforge.functions.patterns import java_pretoken_pattern, specials_pattern

SURROGATE_LO = 0xD800
SURROGATE_SHIFT = 0x800
MAX_TOKEN_ID = 0x10FFFF - SURROGATE_SHIFT


def id_to_char(token_id: int) -> str:
    if token_id < 0 or token_id > MAX_TOKEN_ID:
        raise ValueError(f"token id {token_id} outside 0..{MAX_TOKEN_ID}")
    return chr(token_id if token_id < SURROGATE_LO else token_id + SURROGATE_SHIFT)


def char_to_id(ch: str) -> int:
    cp = ord(ch)
    return cp if cp < SURROGATE_LO else cp - SURROGATE_SHIFT


def ids_to_seq(ids) -> str:
    return "".join(id_to_char(i) for i in ids)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cp_to_id(cp: Column) -> Column:
    return F.when(cp >= SURROGATE_LO, cp - SURROGATE_SHIFT).otherwise(cp)


def seq_from_word(word) -> Column:
    """Token string of a pre-token before any merge: one char per UTF-8 byte."""
    return F.decode(F.encode(_col(word), "UTF-8"), "ISO-8859-1")


def seq_to_ids(seq) -> Column:
    """ARRAY<INT> of the ids held by a token string (empty string -> [])."""
    s = _col(seq)
    n = F.length(s)
    ids = F.transform(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: cp_to_id(F.ascii(F.substr(s, i, F.lit(1)))),
    )
    return F.slice(ids, 1, n).cast("array<int>")


def pair_strings(seq) -> Column:
    """All adjacent pairs (overlapping) of a token string, as 2-char strings."""
    s = _col(seq)
    pairs = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(s) - 1, F.lit(1))),
        lambda i: F.substr(s, i, F.lit(2)),
    )
    return F.filter(pairs, lambda p: F.length(p) == 2)


def pair_strings_bmp(seq) -> Column:
    """Same as ``pair_strings`` as one regex (codegen friendly, no lambdas).

    Only valid while every code point is below U+10000 (token ids < 0xF800):
    java.util.regex would also match inside a surrogate pair.
    """
    return F.regexp_extract_all(_col(seq), F.lit("(?s)(?=(..))"), F.lit(1))


BMP_MAX_ID = 0x10000 - SURROGATE_SHIFT - 1


def pairs_expr(seq, max_id: int) -> Column:
    """Pair strings of a token string whose ids are all <= ``max_id``."""
    return pair_strings_bmp(seq) if max_id <= BMP_MAX_ID else pair_strings(seq)


def pair_left_id(pair) -> Column:
    return cp_to_id(F.ascii(F.substr(_col(pair), F.lit(1), F.lit(1)))).cast("int")


def pair_right_id(pair) -> Column:
    return cp_to_id(F.ascii(F.substr(_col(pair), F.lit(2), F.lit(1)))).cast("int")


def split_on_specials(text, special_tokens=()) -> Column:
    """ARRAY<STRING> of the documents between special tokens (specials dropped)."""
    pat = specials_pattern(special_tokens)
    t = _col(text)
    if pat is None:
        return F.array(t)
    return F.split(t, F.lit(pat), -1)


def specials_in_order(text, special_tokens=()) -> Column:
    """ARRAY<STRING> of the special tokens found in ``text``, in order."""
    pat = specials_pattern(special_tokens)
    if pat is None:
        return F.array().cast("array<string>")
    return F.regexp_extract_all(_col(text), F.lit(pat), F.lit(0))


def pretokens(text, special_tokens=()) -> Column:
    """ARRAY<STRING> of pre-tokens; pre-tokens never span a special token."""
    pat = F.lit(java_pretoken_pattern())
    t = _col(text)
    if specials_pattern(special_tokens) is None:
        return F.regexp_extract_all(t, pat, F.lit(0))
    return F.flatten(
        F.transform(split_on_specials(t, special_tokens),
                    lambda d: F.regexp_extract_all(d, pat, F.lit(0)))
    )


def normalize_newlines(text) -> Column:
    """Universal-newline reading: CRLF and lone CR become LF."""
    return F.replace(F.replace(_col(text), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def split_lines(text) -> Column:
    """ARRAY<STRING> of lines, each keeping its trailing LF (like text-mode files)."""
    return F.regexp_extract_all(normalize_newlines(text), F.lit("[^\n]+\n?|\n"), F.lit(0))


def hex_token(binary) -> Column:
    return F.hex(_col(binary))
