"""Fixed values that must equal the trained-tokenizer conventions.

Fixed values (do not edit; results depend on them):

* Pre-token pattern (GPT-2 style, spaces significant):
  '(?:[sdmt]|ll|ve|re)| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
* Default special token: <|endoftext|>
* Byte alphabet printable ranges kept as themselves: '!'..'~', '¡'..'¬', '®'..'ÿ';
  every other byte b maps to chr(256 + n), n counting those bytes in increasing order.
* Whitespace set of the pre-token pattern (Unicode White_Space, 25 code points):
  U+0009..U+000D, U+0020, U+0085, U+00A0, U+1680, U+2000..U+200A, U+2028, U+2029,
  U+202F, U+205F, U+3000
"""

from functools import cache

# Fixed values ------------------------------------------------------------
PRETOKEN_PATTERN = (
    r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
DEFAULT_SPECIAL_TOKEN = "<|endoftext|>"
PRINTABLE_BYTE_RANGES = ((ord("!"), ord("~")), (ord("¡"), ord("¬")), (ord("®"), ord("ÿ")))
WHITESPACE_CLASS = (
    r"\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# -------------------------------------------------------------------------


def category_ranges(category: str) -> list[tuple[int, int]]:
    """Code-point ranges of a general category above ASCII, by the newest table at hand.

    That is the `regex` module's where it is installed, else the standard library's.
    """
    chars = "".join(map(chr, range(0x80, 0x110000)))
    try:
        import regex
    except ImportError:
        import unicodedata
        from itertools import groupby

        runs = ((k, list(g)) for k, g in groupby(chars, lambda c: unicodedata.category(c)[0] == category))
        return [(ord(g[0]), ord(g[-1])) for k, g in runs if k]
    return [(0x80 + m.start(), 0x80 + m.end() - 1) for m in regex.finditer(rf"\p{{{category}}}+", chars)]


def java_class(ranges: list[tuple[int, int]], leaf: int = 8) -> str:
    """The inside of a java.util.regex class for sorted ranges, as a search tree.

    A plain union tests its ranges one after another; here ``[low-high&&[...]]`` skips
    a half at a time, and a character below the first range costs one test.
    """
    def span(lo, hi):
        return rf"\x{{{lo:X}}}-\x{{{hi:X}}}"

    if len(ranges) <= leaf:
        return "".join(span(*r) for r in ranges)
    mid = len(ranges) // 2
    return "".join(f"[{span(part[0][0], part[-1][1])}&&[{java_class(part, leaf)}]]" for part in (ranges[:mid], ranges[mid:]))


@cache
def java_pretoken_pattern() -> str:
    """The pre-token pattern for java.util.regex, with letters and numbers of the newest Unicode table.

    (?U) makes \\s, \\p{L} and \\p{N} follow the JVM's Unicode tables (25 white-space code points
    instead of 6), which may be years older.  So each class also holds the explicit ranges; the JVM's
    own class comes first and answers for most characters.
    """
    letters, numbers = (f"[{java_class(r)}]" for r in map(category_ranges, "LN"))
    return ("(?U)" + PRETOKEN_PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[^\s\p{{L}}\p{{N}}{letters}{numbers}]")
            .replace(r" ?\p{L}+", rf" ?[\p{{L}}{letters}]+").replace(r" ?\p{N}+", rf" ?[\p{{N}}{numbers}]+"))


def java_quote(literal: str) -> str:
    """Quote a literal for java.util.regex (\\Q..\\E, guarding an inner \\E)."""
    return "\\Q" + literal.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def specials_pattern(special_tokens) -> str | None:
    """Alternation of the specials in list order: leftmost, first-listed wins.

    Empty strings are ignored (an empty alternative would split between every
    character); ``None`` means no split at all.
    """
    alts = [java_quote(s) for s in special_tokens if s]
    return "|".join(alts) if alts else None


def byte_alphabet() -> dict[int, str]:
    """byte -> printable character, built from the rule in the header."""
    keep = {b for lo, hi in PRINTABLE_BYTE_RANGES for b in range(lo, hi + 1)}
    out, shifted = {}, 0
    for b in range(256):
        if b in keep:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + shifted)
            shifted += 1
    return out
