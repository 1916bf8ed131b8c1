"""Operator 9, URL filters: a blocked Bloom filter in front of an exact hash join.

Listed URLs are canonical keys ``host/path``: a host stands for itself and its
subdomains, a path for all paths that start with it.  A URL has one key for each
suffix of its host and each prefix of its path that has the length of a listed
path.  The filter, built from the list by one aggregate, has blocks of 512 bits;
all bits of a key lie in one block.  Keys that pass are joined with the list by
their text, which removes the filter's false positives; the longest listed key
decides, then the smaller verdict text.

The filter has a size bound (``max_blocks`` blocks of 64 bytes); beyond it, it
only passes more keys to the join.  It reaches the tasks as one literal array.

Edge cases: a null URL or one without ``://`` has an empty host and path and no
key; an empty list blocks nothing; repeated rows give repeated rows; entries
listed twice count once; other columns are kept, but for those named host, path,
rule and verdict.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Production list: hosts known for spam, adverts and betting.
SPAM_HOSTS = ("ads-track.example.org", "casino-win.example.org", "cheap-pills.example.com",
              "free-bets.example.com", "spam-farm.example.org")


def url_host(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    url = F.col(url) if isinstance(url, str) else url
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: str | Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    url = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _bits(key_hash: Column, blocks: int, k: int) -> list[tuple[Column, Column]]:
    """(word, mask) of a key's ``k`` bits, all in one block of 8 words of 64 bits."""
    block = F.pmod(key_hash, F.lit(blocks)) * 8
    mixed = F.xxhash64(key_hash)
    out = []
    for i in range(k):  # 9 bits of a second hash choose each bit in the block
        bit = F.shiftrightunsigned(mixed, 9 * i).bitwiseAND(511)
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(63).cast("int"))
        out.append(((block + F.shiftright(bit, 6)).cast("int"), mask))
    return out


def bloom_words(keys: DataFrame, blocks: int, k: int) -> Column:
    """The filter over column ``key`` as one array of ``8 * blocks`` 64-bit words (a scalar subquery)."""
    bits = F.array(*(F.struct(w.alias("word"), m.alias("mask")) for w, m in _bits(F.xxhash64("key"), blocks, k)))
    words = (keys.select(F.explode(bits).alias("b"))
             .groupBy("b.word").agg(F.bit_or("b.mask").alias("mask")))
    slots = keys.sparkSession.range(8 * blocks).select(F.col("id").cast("int").alias("word"))
    rows = slots.join(words, "word", "left").select("word", F.coalesce("mask", F.lit(0).cast("long")).alias("mask"))
    one = rows.agg(F.sort_array(F.collect_list(F.struct("word", "mask"))).alias("w"))
    return one.select(F.col("w.mask").alias("filter")).scalar()


def might_hold(filter_words: Column, key: Column, blocks: int, k: int) -> Column:
    return reduce(and_, (F.get(filter_words, w).bitwiseAND(m) != 0 for w, m in _bits(F.xxhash64(key), blocks, k)))


def judge(pages: DataFrame, listed: DataFrame, url: str = "url", bits_per_key: int = 16, k: int = 6,
          max_blocks: int = 1 << 16, default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (the deciding listed key or null) and verdict.

    ``listed`` has columns key (``host/path``, the path may be ``/``), verdict
    and source; ``rule`` stays null where the entry's ``source`` is not ``rule``,
    and entries of source ``rule`` go before all others.
    """
    listed = listed.groupBy("key", "source").agg(F.min("verdict").alias("verdict"))
    sizes = listed.select(F.countDistinct("key").alias("n"),
                          F.collect_set(F.length("key") - F.locate("/", "key") + 1).alias("lengths")).first()
    n, lengths = sizes["n"], sorted(sizes["lengths"])  # distinct path lengths of the list
    blocks = max(1, min(max_blocks, -(-n * bits_per_key // 512)))
    base = pages.withColumn("host", url_host(url)).withColumn("path", url_path(url))
    if not n:
        return base.drop("rule", "verdict").select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = F.filter(F.array(*map(F.lit, lengths)), lambda n_: n_ <= F.length("path"))
    prefixes = F.transform(fitting, lambda n_: F.substring("path", F.lit(1), n_))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    words = bloom_words(listed.select("key").distinct(), blocks, k)
    urls = base.select("host", "path").where("path <> ''").distinct()
    hits = urls.select("host", "path", F.explode(keys).alias("key")).where(might_hold(words, F.col("key"), blocks, k))
    rank = F.struct((F.col("source") == "rule").alias("own"), F.length("key").alias("n"),
                    (F.col("verdict") == default).alias("mild"), "key")
    best = (hits.join(listed, "key").groupBy("host", "path")
            .agg(F.max_by(F.struct("key", "verdict", "source"), rank).alias("__best")))
    kept = [f"`{c}`" for c in base.columns if c not in ("rule", "verdict")]
    return base.join(best, ["host", "path"], "left").select(
        *kept, F.when(F.col("__best.source") == "rule", F.col("__best.key")).alias("rule"),
        F.coalesce("__best.verdict", F.lit(default)).alias("verdict"))
