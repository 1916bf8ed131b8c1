"""Operator 1, quality rules: base counts and a hashed n-gram log-likelihood ratio.

Every text is seen as a bag of one- and two-word n-grams hashed to ``buckets``
buckets.  Two multinomials with additive smoothing (``alpha`` in counts of the target,
the same share of the raw corpus) are counted over them: the raw corpus (all documents) and a trusted target (labelled documents; a bounded sample
of at most ``target_rows`` labels, chosen by the hash of the key, a parameter).  A
document's score is the mean over its n-grams of log(target / raw); weights are
rounded to millionths of a nat, so sums are exact and do not depend on order.  It
is kept if the base rules hold and the score is at least ``threshold``.

All of it is DataFrame expressions.  The corpus is counted by one aggregate that is
combined on the map side; its result has ``buckets`` rows, a bound by parameter,
and reaches the scoring projection as one literal array.  Scoring has no shuffle.

Three-word windows are compared by 64-bit hashes of three 64-bit word hashes.

Edge cases: a null or empty text, or one of white space, has zero counts and fails
the base rules; one word has one n-gram; repeated rows count as often as they come
and get equal results; without trusted rows all weights are zero and the base rules
decide; an empty table gives an empty one; ``judge`` keeps other columns but replaces those
named like its own.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import WS, pin, text_or_empty

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _words(text: Column) -> Column:
    body = F.btrim(text, F.lit(WS))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, r"[\x09-\x0D ]+"))


def _chars_of(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def hashed(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the array ``__h`` of word hashes."""
    return docs.withColumn("__h", F.transform(_words(text_or_empty(text)), lambda w: F.xxhash64(w)))


def _grams(h: Column, n: int) -> Column:
    """Hashes of all n-word windows of the word hashes ``h``."""
    many = F.size(h) - F.lit(n - 1)
    at = F.when(many > 0, F.slice(h, 1, F.greatest(many, F.lit(0)))).otherwise(F.array().cast("array<bigint>"))
    return F.transform(at, lambda x, i: F.xxhash64(x, *(F.get(h, i + j) for j in range(1, n))))


def buckets_of(h: Column, buckets: int) -> Column:
    """Buckets of the one- and two-word n-grams."""
    m = F.lit(buckets)
    return F.concat(F.transform(h, lambda x: F.pmod(x, m).cast("int")),
                    F.transform(_grams(h, 2), lambda x: F.pmod(x, m).cast("int")))


def weights(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text",
            buckets: int = 1 << 16, alpha: float = 10.0) -> list[int]:
    """log(target / raw) of each bucket in millionths; ``trusted`` holds a bounded set of keys."""
    mine = trusted.select(F.col(key).alias("__key"), F.lit(1).alias("__trusted")).dropDuplicates(["__key"])
    marked = docs.select(key, text).join(F.broadcast(mine), F.col(key) == F.col("__key"), "left")
    grams = hashed(marked, text).select("__trusted", F.explode(buckets_of(F.col("__h"), buckets)).alias("b"))
    counted = pin(grams.groupBy("b").agg(F.count(F.lit(1)).alias("raw"), F.count("__trusted").alias("good")))
    n_raw, n_good = counted.agg(F.sum("raw"), F.sum("good")).first()
    if not n_good:
        return [0] * buckets
    share = n_good / n_raw
    of = F.log(F.col("good") + alpha) - F.log(F.col("raw") * share + alpha)
    out = [0] * buckets  # buckets that no document has
    for r in counted.select("b", F.round(of * 1e6).cast("long").alias("w")).collect():  # at most ``buckets`` rows
        out[r["b"]] = r["w"]
    return out


def _sorted_windows(h: Column) -> Column:
    """(hash, position) of the three-word windows in order of hash; null if all differ."""
    grams = _grams(h, 3)
    some = F.size(F.array_distinct(grams)) < F.size(grams)
    return F.when(some, F.sort_array(F.transform(grams, lambda x, i: F.struct(x.alias("g"), i.alias("i")))))


def _repeated_at(s: Column) -> Column:
    """Positions, in order, of the windows that have an equal neighbour in ``s``."""
    def equal(x, j):
        return F.coalesce(x["g"] == F.get(s, j)["g"], F.lit(False))

    found = F.filter(s, lambda x, i: equal(x, i + 1) | (F.when(i > 0, equal(x, i - 1)).otherwise(False)))
    return F.sort_array(F.transform(found, lambda x: x["i"]))


def _covered(p: Column) -> Column:
    """Words covered by three-word windows at the positions ``p``."""
    own = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
    return F.coalesce(F.aggregate(own, F.lit(0), lambda a, x: a + x), F.lit(0))


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base counts, ``base_failed`` and the word hashes ``__h``."""
    body = text_or_empty(text)
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(WS)) != "")
    d = hashed(docs, text).withColumn("__lines", lines).withColumn("__sorted", _sorted_windows(F.col("__h")))
    d = d.withColumn("__at", _repeated_at(F.col("__sorted")))
    counts = {
        "n_words": F.size("__h"),
        "word_chars": F.length(body) - _chars_of(body, WS),
        "n_symbols": _chars_of(body, SYMBOLS),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": _covered(F.col("__at")),
    }
    d = d.withColumns({c: x.cast("long") for c, x in counts.items()}).drop("__lines", "__sorted", "__at")
    return d.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def judge(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = 1 << 16,
          alpha: float = 10.0, threshold: float = -0.09) -> DataFrame:
    """``docs`` with the base counts, base_failed, ``llr`` (null without words) and ``kept``."""
    own = weights(docs, trusted, key, text, buckets, alpha)
    # ``buckets`` numbers, folded to one literal array
    table = F.from_json(F.lit(json.dumps(own)), "array<bigint>")
    d = base_counts(docs, text).withColumn("__b", buckets_of(F.col("__h"), buckets)).drop("__h")
    total = F.aggregate("__b", F.lit(0).cast("long"), lambda a, b: a + F.get(table, b))
    d = d.withColumn("llr", F.when(F.size("__b") > 0, total / F.size("__b") / 1e6)).drop("__b")
    d = d.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("llr") >= threshold, F.lit(False)))
    # A generator of one row keeps a later filter on the verdict above these expressions: pushed
    # below, it would be evaluated with all arrays inlined, once for each element.
    made = [*COUNTS, "base_failed", "llr", "kept"]
    return d.select(*[F.col(f"`{c}`") for c in docs.columns if c not in made], F.inline(F.array(F.struct(*made))))


def trusted_keys(labels: DataFrame, key: str = "doc_id", target_rows: int = 20_000) -> DataFrame:
    """At most ``target_rows`` keys labelled good and not toxic, the least by hash."""
    good = labels.where((F.col("quality") == 1) & (F.col("toxic") == 0)).select(key).dropna().distinct()
    return good.orderBy(F.xxhash64(key), key).limit(target_rows)
