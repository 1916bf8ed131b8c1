"""Operator 12, personal data by aggregated weak supervision.

Base spans are four patterns (email, ip, card, phone) with a check each, over whole texts.
The method looks further: it proposes candidates of the same kinds in looser forms and of
two more (``ssn``, ``name``), and five labelers vote on each candidate: yes, no or nothing.

=========  ==========================================================================
strict     the base pattern: yes where it holds, no where its check fails
shape      stands alone, not inside a longer token
check      checksums and ranges (Luhn, octets, digit counts, reserved numbers)
gazetteer  top-level domains, country codes, card prefixes, given names
context    words just before the span that speak for or against its kind
=========  ==========================================================================

One scan of the texts writes each document's base spans and candidates (places, votes and
features, no text) to the shared checkpoint folder.  Votes are counted over all documents; that
table has at most kinds * 3^5 * 2^8 rows and goes to the driver, where expectation-maximisation
estimates for each kind the share of true candidates and for each labeler how it votes on true
and false ones.  Its posteriors are the soft labels of the final classifier, a logistic regression
on the features of a span alone, so it also judges spans on which the labelers keep silent.  A
second pass over the written candidates, without texts or a shuffle, adds those at ``threshold``
or above that touch no base span; of overlapping ones the likelier stays, then the earlier.

A span to which context alone objects still passes where the other labelers agree.

All patterns take time in proportion to the text: an email is sought from its ``@``, numbers
from the start of a run of digits, and the looser forms have bounded parts.

Edge cases: a null or empty text has no span; repeated rows give repeated rows; ties in start
go by kind as listed; positions are code points, ends exclusive; an empty table gives an empty
one; a kind without candidates adds nothing; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import arrow_batches, spill_table

KINDS = ("email", "ip", "card", "phone", "ssn", "name")
LABELERS = ("strict", "shape", "check", "gazetteer", "context")
FEATURES = ("strict", "alone_left", "alone_right", "check", "gazetteer", "cue", "counter_cue", "grouped")

# Public lists.
TLDS = frozenset("com org net edu gov mil int info biz io co ai app dev me tv uk us de fr es it nl be ch at pt pl se no dk fi ie ru cn jp kr in br mx ar ca au nz za".split())
COUNTRY_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 351 352 353 358 380 420 852 886 971 972".split())
GIVEN = ("James John Robert Michael William David Richard Joseph Thomas Charles Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica "
         "Sarah Karen Daniel Matthew Anthony Mark Paul Steven Andrew Kevin Laura Emma Anna Maria Sophie Peter Hans Klaus Jürgen Wolfgang Ursula "
         "Sabine Pierre Jean Jacques Marie Camille Juan José Carlos Luis Miguel Carmen Lucía Pablo").split()
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Mme Mlle Señor Señora Sr Sra".split()
CUES = {
    "email": "email e-mail mail contact write reach correo courriel kontakt",
    "ip": "ip host server address client addr from login serveur servidor",
    "card": "card visa mastercard amex credit debit payment karte carte tarjeta",
    "phone": "phone call tel telephone mobile cell fax whatsapp telefon téléphone teléfono",
    "ssn": "ssn social security insurance tax",
    "name": "name named contact sincerely regards signed called heißt nom nombre",
}
COUNTER_CUES = "version order invoice isbn issn build release section chapter part serial tracking item sku ref doi page pages id hash commit"
_CUES = [frozenset(CUES[k].split()) for k in KINDS]
_COUNTER = frozenset(COUNTER_CUES.split())

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match ends where its digits end, so none can start inside a run of digits.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT = re.compile(r"\s?(?:\(at\)|\[at\]|\{at\})\s?|\sat\s", re.I)
_DOT = r"(?:\s?(?:\(dot\)|\[dot\]|\{dot\})\s?|\sdot\s)"
_SPELLED = re.compile(rf"[A-Za-z0-9-]{{1,63}}(?:(?:{_DOT}|\.)[A-Za-z0-9-]{{1,63}}){{1,8}}", re.I)
_HAS_DOT = re.compile(_DOT, re.I)
_NATIONAL = re.compile(r"(?<![0-9+])(?<![0-9][\x20.-])(?:\([0-9]{2,5}\)[\x20.-]?|[0-9]{2,5}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![\x20.-]?[0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_IPV6 = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])")
_PART = r"[A-ZÀ-Þ][a-zß-ÿ]{1,20}"
_NAME = re.compile(rf"(?<!\w)(?:(?:{'|'.join(TITLES)})\.?\x20{_PART}|(?:{'|'.join(GIVEN)}))(?:\x20{_PART}){{0,2}}(?!\w)")
_WORDS = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        total += x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
    return total % 10 == 0


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def _octets(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def _digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def base_matches(text: str):
    """(kind, start, end, holds) of every match of a base pattern; those whose check fails do not hold."""
    if "@" in text:
        for s, e in _emails(text):
            yield 0, s, e, True
    for m in _IP.finditer(text):
        yield 1, m.start(), m.end(), _octets(m[0])
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = _digits(m[0])
            yield 2, m.start(), m.end(), 12 <= len(d) <= 19 and luhn(d)
    if "+" in text:
        for m in _PHONE.finditer(text):
            yield 3, m.start(), m.end(), 9 <= len(_digits(m[0])) <= 15


def _loose(text: str):
    """(kind, start, end) of the looser forms."""
    for m in _AT.finditer(text) if " at " in text or "at)" in text.lower() or "at]" in text.lower() or "at}" in text.lower() else ():
        left = _LOCAL_END.search(text, max(0, m.start() - 64), m.start())
        right = _SPELLED.match(text, m.end())
        if left and right and (m[0].strip().lower() != "at" or _HAS_DOT.search(right[0])):
            yield 0, left.start(), right.end()
    for m in _IPV6.finditer(text) if text.count(":") >= 7 else ():
        yield 1, m.start(), m.end()
    for m in _NATIONAL.finditer(text):
        yield 3, m.start(), m.end()
    for m in _SSN.finditer(text):
        yield 4, m.start(), m.end()
    for m in _NAME.finditer(text):
        if " " in m[0]:
            yield 5, m.start(), m.end()


def _check(kind: int, s: str) -> bool:
    if kind == 0:
        return len(s) <= 254 and ".." not in s
    if kind == 1:
        return ":" in s or _octets(s) and not s.startswith("0.")
    d = _digits(s)
    if kind == 2:
        return 12 <= len(d) <= 19 and luhn(d) and len(set(d)) > 1
    if kind == 3:
        return 9 <= len(d) <= 15 and len(set(d)) > 2
    if kind == 4:
        return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
    return len(s.split()) >= 2


def _listed(kind: int, s: str) -> int:
    """Vote of the gazetteers: 1, 0 or -1."""
    if kind == 0:
        return 1 if re.split(r"[^A-Za-z]+", s.rstrip(")]}"))[-1].lower() in TLDS else -1
    if kind == 2:
        d = _digits(s)
        return 1 if d[0] in "3456" or "2221" <= d[:4] <= "2720" else 0
    if kind == 3:
        d = _digits(s)
        return (1 if any(d[:n] in COUNTRY_CODES for n in (1, 2, 3)) else -1) if s[0] == "+" else 0
    if kind == 5:
        first = s.split()
        return 1 if any(w in GIVEN for w in first) or first[0].rstrip(".") in TITLES else -1
    return 0


def candidate(text: str, kind: int, start: int, end: int, strict: int) -> tuple[int, int, int, int, int]:
    """(kind, start, end, votes, features): votes in base 3 (0 no, 1 nothing, 2 yes), features as bits."""
    s = text[start:end]
    left = start == 0 or not (text[start - 1].isalnum() or text[start - 1] in "_@")
    right = end == len(text) or not (text[end].isalnum() or text[end] in "_@")
    check, listed = _check(kind, s), _listed(kind, s)
    near = {w.lower() for w in _WORDS.findall(text[max(0, start - 40):start])}
    cue, counter = bool(near & _CUES[kind]), bool(near & _COUNTER)
    if kind == 5 and s.split()[0].rstrip(".") in TITLES:
        cue = True
    votes = (strict, 1 if left and right else -1, 1 if check else -1, listed, cue - counter)
    grouped = bool(re.search(r"[\x20()-]", s)) if kind in (2, 3, 4) else kind == 0 and "@" not in s
    bits = (strict > 0, left, right, check, listed > 0, cue, counter, grouped)
    return kind, start, end, sum((v + 1) * 3 ** i for i, v in enumerate(votes)), sum(b << i for i, b in enumerate(bits))


def scan(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, int, int]]]:
    """Base spans (start, kind, end) in order, and all candidates, base spans among them."""
    if not text:
        return [], []
    base, candidates = [], []
    for kind, s, e, holds in base_matches(text):
        if holds:
            base.append((s, kind, e))
        if holds or kind in (1, 3) or kind == 2 and e - s <= 40:
            candidates.append(candidate(text, kind, s, e, 1 if holds else -1))
    candidates += [candidate(text, kind, s, e, 0) for kind, s, e in _loose(text)]
    return sorted(base), candidates


CANDIDATE = "array<struct<kind:int,start:int,end:int,votes:int,features:int>>"


def scan_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, base, candidates`` of every row, written to the shared checkpoint folder.

    ``base``: three numbers (start, kind, end) for each base span.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        item = pa.struct([(n, pa.int32()) for n in ("kind", "start", "end", "votes", "features")])
        for b in batches:
            found = [scan(t) for t in b.column(1).to_pylist()]
            flat = [c for _, cs in found for c in cs]
            ends = np.cumsum([0, *(len(cs) for _, cs in found)])
            parts = [pa.array([c[i] for c in flat], pa.int32()) for i in range(5)]
            cands = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(parts, fields=list(item)))
            base = pa.array([[x for span in spans for x in span] for spans, _ in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), base, cands], names=[key, "base", "candidates"])

    with arrow_batches(docs.sparkSession):
        return spill_table(docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, base array<int>, candidates {CANDIDATE}"), "pii-candidates")


def patterns(scanned: DataFrame) -> list[tuple[int, int, int, int]]:
    """(kind, votes, features, n) over all candidates; at most kinds * 3^5 * 2^8 rows."""
    flat = scanned.select(F.explode("candidates").alias("c")).groupBy("c.kind", "c.votes", "c.features").agg(F.count(F.lit(1)).alias("n"))
    return sorted((r["kind"], r["votes"], r["features"], r["n"]) for r in flat.collect())


def _unpack(votes: np.ndarray) -> np.ndarray:
    return votes[:, None] // 3 ** np.arange(len(LABELERS)) % 3


def reliabilities(kinds, votes, n, rounds: int = 200, prior: float = 0.2):
    """Expectation-maximisation over counted vote patterns.

    Returns (posterior of each pattern, {kind: share of true ones}, P[truth, labeler, no or yes]).  Each
    kind has a share of its own; a labeler is as reliable on all of them, so kinds with many errors teach
    what a vote is worth on the others.  Silence says nothing: a form that a labeler does not know is not
    a vote.  It starts from the votes, a no weighing three yes (checks and counter-cues seldom err).
    Pseudo-votes, ``prior`` times the candidates, say that labelers are right rather than wrong and
    shares are even, so a lone labeler that objects is not explained away by those that always agree.
    """
    _, group = np.unique(np.asarray(kinds), return_inverse=True)
    v, n = _unpack(np.asarray(votes)), np.asarray(n, float)
    pseudo = (1 + prior * n.sum()) * np.array([[0.8, 0.2], [0.1, 0.9]])  # rows: false, true; votes: no, yes
    q = 1 / (1 + np.exp(-((v == 2).sum(1) - 3.0 * (v == 0).sum(1))))
    one_hot = np.eye(3)[v][:, :, ::2]  # pattern, labeler, no or yes
    total = np.bincount(group, n)
    for _ in range(rounds):
        share = (np.bincount(group, n * q) + 1 + prior * total / 2) / (total + 2 + prior * total)
        told = np.stack([np.einsum("p,plv->lv", n * w, one_hot) + pseudo[k] for k, w in enumerate((1 - q, q))])
        told /= told.sum(2, keepdims=True)
        score = (np.log(share) - np.log(1 - share))[group] + np.einsum("plv,lv->p", one_hot, np.log(told[1]) - np.log(told[0]))
        q = 1 / (1 + np.exp(-np.clip(score, -500, 500)))
    return q, dict(zip(np.unique(np.asarray(kinds)).tolist(), share)), told


def bits(features) -> np.ndarray:
    """Design matrix: a constant and one column a feature."""
    f = np.asarray(features)[:, None] >> np.arange(len(FEATURES)) & 1
    return np.concatenate([np.ones((len(f), 1)), f], 1)


def fit_classifier(features, q, n, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Logistic regression on soft labels ``q`` of ``n`` spans each, by Newton steps."""
    x, q, n = bits(features), np.asarray(q, float), np.asarray(n, float)
    w = np.zeros(x.shape[1])
    pull = ridge * np.eye(len(w))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + pull, x.T @ (n * (q - p)) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-10:
            break
    return w


def fit(counted) -> dict[int, np.ndarray]:
    """Weights of the classifier of each kind that has candidates, from ``patterns``."""
    if not counted:
        return {}
    kinds, votes, features, n = (np.array(c) for c in zip(*counted))
    q, _, _ = reliabilities(kinds, votes, n)
    return {int(k): fit_classifier(features[kinds == k], q[kinds == k], n[kinds == k]) for k in np.unique(kinds)}


def chances(model: dict[int, np.ndarray]) -> np.ndarray:
    """Probability for every kind and set of features."""
    out = np.zeros((len(KINDS), 1 << len(FEATURES)))
    x = bits(np.arange(1 << len(FEATURES)))
    for kind, w in model.items():
        out[kind] = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return out


def chosen(base, candidates, table, threshold: float):
    """All spans (start, kind, end): base ones and the candidates that pass, without overlaps among or with them."""
    spans = [tuple(base[i:i + 3]) for i in range(0, len(base), 3)]
    taken: list[tuple[int, int]] = []  # disjoint and in order
    for s, _, e in sorted(spans):
        if taken and s < taken[-1][1]:
            s, e = taken[-1][0], max(e, taken[-1][1])
            taken.pop()
        taken.append((s, e))
    ranked = sorted((-table[c["kind"]][c["features"]], c["start"], -c["end"], c["kind"]) for c in candidates
                    if table[c["kind"]][c["features"]] >= threshold)
    for _, s, e, kind in ranked:
        i = bisect_left(taken, (s, -1))
        if (i == 0 or taken[i - 1][1] <= s) and (i == len(taken) or -e <= taken[i][0]):
            taken.insert(i, (s, -e))
            spans.append((s, kind, -e))
    return sorted(spans)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of every row."""
    scanned = scan_documents(docs, key, text)
    table = chances(fit(patterns(scanned)))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for b in batches:
            base, cands = b.column(1).to_pylist(), b.column(2).to_pylist()
            own = [[tuple(x[i:i + 3]) for i in range(0, len(x), 3)] for x in base]
            spans = [chosen(x, c, table, threshold) if c else [] for x, c in zip(base, cands)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([sum(s[1] == k for s in o) for o in own], pa.int64()) for k in range(4)),
                 pa.array([hashlib.sha256(_joined(o).encode()).hexdigest() for o in own], pa.string()),
                 pa.array([_joined(s) for s in spans], pa.string()),
                 pa.array([len(s) - len(o) for s, o in zip(spans, own)], pa.int64())],
                names=[key, "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return scanned.mapInArrow(run, f"`{key}` {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
