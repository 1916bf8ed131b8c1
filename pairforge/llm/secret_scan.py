"""Operator 4, secret scans by assignment-aware lexing.

Base spans are three patterns (assign, access, hex) over the whole text.  The method
adds spans of kind ``literal``: source and configuration syntax is lexed into
statements ``name operator value``, a value being a chain of quoted literals, bare
words and names.  Names bound to literals are constants and are propagated through
later statements, so a literal counts for every name it reaches.  Each literal is
scored by the most sensitive name among its targets and by its own look (length,
entropy, mix of characters, placeholders); literals at or above ``threshold`` that no
base span covers are reported where they stand.

A name starts where no name character stands before it, so a long run is read once and a text takes
time in proportion to its length.  A name bound to over ``PARTS`` literals keeps none of them for later names.

Edge cases: a null or empty text has no span; repeated rows give repeated rows; ties
in start go by kind as listed; positions are code points, ends exclusive; an empty
table gives an empty one; other columns are kept by ``redact``, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import text_batches

KINDS = ("assign", "access", "hex", "literal")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

#: How much a word in a target name says about its value.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "secrets": 1.0,
             "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "privatekey": 1.0,
             "accesskey": 1.0, "mnemonic": 0.9, "seedphrase": 0.9, "recoveryphrase": 0.9, "authkey": 0.9, "encryptionkey": 0.9, "signingkey": 0.9, "bearer": 0.8}
_HINT = re.compile("|".join(["pass", "pwd", "secret", "token", "key", "credential", "bearer", "mnemonic", "phrase"]))
_PLACEHOLDER = re.compile(r"(?i)^(?:(?:your|my|the|some)?[-_.]?(?:change.?me|example|sample|dummy|test|todo|none|null|true|false|undefined"
                          r"|password|passwd|secret|token|string|value|key|api[-_.]?key)(?:[-_.]?(?:here|key|value|goes[-_.]?here))?"
                          r"|x+|\*+|\.+|-+|_+|<.*>|\$\{.*\}|%.*%)\d*$")
#: Names whose values are words with blanks.
_PHRASE = re.compile(r"(?i)pass.?phrase|mnemonic|(?:seed|recovery).?(?:phrase|words)")
#: A name bound to more literals than this is unbound.
PARTS = 256

_QUOTED = r""""(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`(?:[^`\\\n]|\\.)*`"""
_NAME = r"[A-Za-z_$][\w$]*(?:[.-][A-Za-z_$][\w$]*)*"
_BRACED = rf"\$\{{{_NAME}\}}"
_STATEMENT = re.compile(rf"""(?x)
    (?: (?<![\w$])(?<![\w$][.-]) (?P<name>{_NAME}) | (?P<q>["'])(?P<qname>{_NAME})(?P=q) ) (?:["']?\])?   # name, "name", conf["name"]
    [\x20\t]* (?: :=|=>|=(?!=)|:(?!:) ) [\x20\t]*
    (?P<value> (?:{_QUOTED}|{_BRACED}|[^\s"'`,;+(){{}}\[\]<>]+)
               (?: [\x20\t]*\+[\x20\t]* (?:{_QUOTED}|{_BRACED}|{_NAME}) )* )""", re.A)
_TERM = re.compile(rf"{_QUOTED}|{_BRACED}|[^\s\"'`,;+(){{}}\[\]<>]+", re.A)
_REFERENCE = re.compile(rf"^(?:\$\{{({_NAME})\}}|\$?({_NAME}))$", re.A)
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


def name_weight(name: str) -> float:
    """Weight of the most sensitive word, or pair of words, of a name in any case style."""
    words = [w.lower() for w in _WORD.findall(name)]
    pairs = [a + b for a, b in zip(words, words[1:])]
    return max((SENSITIVE.get(w, 0.0) for w in words + pairs), default=0.0)


def literal_score(value: str, quoted: bool, phrase: bool = False) -> float:
    """0 to 1: does the value look like a secret rather than a word, a number or a placeholder?

    White space speaks against it but in a quoted ``phrase`` of three words or more on one line.
    """
    n = len(value)
    blank = any(map(str.isspace, value))
    if n < 6 or _PLACEHOLDER.match(value) or blank and not (phrase and quoted and "\n" not in value and len(value.split()) >= 3):
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    kinds = sum(any(map(f, value)) for f in (str.isdigit, str.islower, str.isupper)) + any(not c.isalnum() for c in value)
    if kinds < 2 and entropy < 3.5 or not quoted and not (kinds >= 2 and any(map(str.isdigit, value))):
        return 0.0
    return min(1.0, 0.25 * min(n, 20) / 20 + 0.5 * min(entropy, 4.0) / 4.0 + 0.25 * min(kinds, 3) / 3)


def literals(text: str, threshold: float = 0.6) -> list[tuple[int, int]]:
    """Places of literals that reach a sensitive name."""
    if not _HINT.search(text.lower()):
        return []
    bound: dict[str, tuple] = {}
    best: dict[tuple[int, int], float] = {}
    for m in _STATEMENT.finditer(text):
        name = m["name"] or m["qname"]
        parts = []  # (start, end, value, quoted) of each literal that makes up the value
        for t in _TERM.finditer(text, m.start("value"), m.end("value")):
            s, e, word = t.start(), t.end(), t[0]
            if word[0] in "\"'`":
                parts.append((s + 1, e - 1, word[1:-1], True))
                ref = _REFERENCE.match(word[1:-1]) if word[1:2] == "$" else None
            else:
                ref = _REFERENCE.match(word)
                if not ref or (ref[1] or ref[2]) not in bound:
                    parts.append((s, e, word, False))
            if ref and (ref[1] or ref[2]) in bound:
                parts += bound[ref[1] or ref[2]]
        if len(parts) <= PARTS:
            bound[name] = tuple(parts)
        else:  # no constant that a later name should get
            bound.pop(name, None)
        weight = name_weight(name)
        if weight:
            whole = "".join(p[2] for p in parts)
            score = weight * literal_score(whole, all(p[3] for p in parts), bool(_PHRASE.search(name)))
            for s, e, _, _ in parts if score >= threshold else ():
                if e > s:
                    best[s, e] = max(best.get((s, e), 0.0), score)
    return sorted(best)


def scan(text: str | None, threshold: float = 0.6) -> list[tuple[int, int, int, int, int]]:
    """(start, kind, end, start of the secret, end of the secret) in order of start, then kind as listed."""
    if not text:
        return []
    low = text.lower()
    out = []
    if "pass" in low or "secret" in low or "token" in low or "api" in low:
        out += [(m.start(), 0, m.end(), m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end(), m.start(), m.end()) for m in HEX.finditer(text)]
    added = literals(text, threshold)
    if added:
        covered = [(s, e) for s, _, e, _, _ in out]
        out += [(s, 3, e, s, e) for s, e in added if not any(a <= s and e <= b for a, b in covered)]
    return sorted(out)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _, _ in spans)


def scan_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.6) -> DataFrame:
    """(key, n_assign, n_access, n_hex, base_sha256, spans, n_literal) of every row."""
    text_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for b in batches:
            found = [scan(t, threshold) for t in b.column(1).to_pylist()]
            counts = [[sum(x[1] == k for x in f) for f in found] for k in range(4)]
            base = [hashlib.sha256(_joined([x for x in f if x[1] < 3]).encode()).hexdigest() for f in found]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in counts[:3]), pa.array(base, pa.string()),
                 pa.array([_joined(f) for f in found], pa.string()), pa.array(counts[3], pa.int64())],
                names=[key, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal"])

    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_literal long")


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", threshold: float = 0.6) -> DataFrame:
    """``docs`` with each secret in the text replaced by ``mark``; overlapping ones become one mark."""
    text_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def cleaned(column):
        def one(t):
            if t is None:
                return None
            out, at = [], 0
            for s, e in sorted((x[3], x[4]) for x in scan(t, threshold)):
                if s >= at:
                    out += [t[at:s], mark]
                at = max(at, e)
            return "".join([*out, t[at:]])

        return column.map(one, na_action="ignore").where(column.notna(), None)

    return docs.withColumn(text, cleaned(F.col(f"`{text}`")))
