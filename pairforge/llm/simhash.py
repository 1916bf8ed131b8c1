"""Operator 10, SimHash near-dedup by the generalised pigeonhole principle.

Fingerprints of 64 bits link at ``max_distance`` or fewer differing bits.  Bits are
grouped in partitions, each with a threshold of its own (-1: not probed); if the
thresholds sum to ``max_distance - partitions + 1``, every linked pair is within
the threshold in at least one partition.  Correlated bits are put in one partition,
and the thresholds (and the number of partitions) are chosen by dynamic programming
on candidate counts estimated from a bounded sample of fingerprints.  The sample
steers cost only: whatever is chosen, all linked pairs are found.

Work is on distinct fingerprints, so exact copies meet in one pre-aggregated row.
Each is indexed by its bits in a partition and probes all keys within that
partition's threshold.  Rows of a key are read as a sorted run; an index run holds
at most ``block`` fingerprints (keys with more are split in blocks by hash, and
their probes visit each block).  Verified links leave a task as a spanning set:
few runs give their pairs, large runs give each member's smallest linked member,
so no group is expanded into all its pairs.

Edge cases: a null or empty text, or one of white space, has fingerprint zero and
links like any other; ties (equal fingerprints) form one class; a null key is
ignored in the class minimum (a class of null keys has a null id); repeated rows
give repeated rows; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import parts_for, pin, text_batches
from pairforge.llm.graph import components

SAMPLE = 2000
#: Relative cost of one shuffled probe row and of one verified candidate pair.
ROW_COST, PAIR_COST = 100.0, 1.0


def fingerprint_of(text: str | None, words_per_shingle: int = 4, seed: int = 42) -> int:
    """A bit is 1 if it is set in over half the shingles' XXH64 values (repeats included)."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # bytes: A-Z and the six white-space bytes only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(words_per_shingle, len(words))
    starts = [0, *(ends[:len(words) - k] + 1).tolist()]
    stops = ends[k - 1:].tolist()
    total = np.zeros(64, "int64")
    for at in range(0, len(starts), 8192):
        h = np.array([xxh64_intdigest(joined[s:e], seed) for s, e in zip(starts[at:at + 8192], stops[at:at + 8192])],
                     "<u8")
        total += np.unpackbits(h.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="int64")
    bits = 2 * total > len(starts)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 words_per_shingle: int = 4, seed: int = 42) -> DataFrame:
    """(key, fp, text_hash): fp as a signed 64-bit integer, text_hash tells rows of one key apart."""
    text_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            fps = np.array([fingerprint_of(t.as_py(), words_per_shingle, seed) for t in b.column(1)], "u8")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view("i8")), b.column(2)],
                                             names=[key, "fp", "text_hash"])

    return docs.select(key, text, F.xxhash64(text).alias("text_hash")).mapInArrow(
        run, f"`{key}` {kind}, fp long, text_hash long")


def flips(mask: int, threshold: int) -> list[int]:
    """All ways to change at most ``threshold`` bits of ``mask``."""
    bits = [1 << i for i in range(64) if mask >> i & 1]
    return [sum(c) for t in range(threshold + 1) for c in combinations(bits, t)]


def group_bits(sample, parts: int) -> list[int]:
    """Masks of ``parts`` partitions of near equal width; each grows by its most correlated bit."""
    import numpy as np

    bits = np.unpackbits(sample.view("u1").reshape(-1, 8), axis=1, bitorder="little").astype(float)
    bits -= bits.mean(axis=0)
    norm = np.sqrt((bits ** 2).sum(axis=0))
    norm[norm == 0] = 1
    corr = np.abs(bits.T @ bits) / np.outer(norm, norm)
    np.fill_diagonal(corr, 0)
    left, masks = list(range(64)), []
    for p in range(parts):
        width = len(left) // (parts - p)
        own = [max(left, key=lambda b: (corr[b, left].max(), -b))]
        left.remove(own[0])
        while len(own) < width:
            nxt = max(left, key=lambda b: (corr[b, own].mean(), -b))
            own.append(nxt)
            left.remove(nxt)
        masks.append(sum(1 << b for b in own))
    return masks


def allocate(sample, n: int, max_distance: int) -> list[tuple[int, int]]:
    """(mask, threshold) of each probed partition; cheapest plan by dynamic programming over estimated counts."""
    import numpy as np

    some = sample[:SAMPLE]
    left, right = np.triu_indices(len(some), 1)
    apart = some[left] ^ some[right] if len(some) > 1 else np.zeros(0, "u8")
    best = None
    for parts in range(1, max_distance + 2):
        masks = group_bits(sample, parts) if len(sample) else [((1 << 64) - 1) // parts]
        budget = max_distance - parts + 1
        table = {0: (0.0, [])}  # thresholds so far, plus one each -> cost, choice
        for mask in masks:
            width = mask.bit_count()
            far = np.bincount(np.bitwise_count(apart & np.uint64(mask)), minlength=65)
            nxt: dict[int, tuple[float, list]] = {}
            for t in range(-1, max_distance + 1):
                ways = sum(comb(width, d) for d in range(t + 1))
                if ways > 200_000:
                    break
                share = max(far[:t + 1].sum() / max(1, len(apart)), ways / 2.0 ** width) if t >= 0 else 0.0
                cost = ROW_COST * n * ways + PAIR_COST * n * n / 2 * share
                for used, (c, chosen) in table.items():
                    if used + t + 1 <= budget + parts and (used + t + 1 not in nxt or c + cost < nxt[used + t + 1][0]):
                        nxt[used + t + 1] = (c + cost, [*chosen, t])
            table = nxt
        got = table.get(budget + parts)
        if got and (best is None or got[0] < best[0]):
            best = (got[0], [(m, t) for m, t in zip(masks, got[1]) if t >= 0])
    return best[1]


def _links(batches, max_distance: int):
    """Runs of one (part, key, block), index rows first -> links, as a spanning set for large runs."""
    import numpy as np
    import pyarrow as pa

    none = np.zeros(0, "u8")
    held_key, held = None, none
    for b in batches:
        cols = [np.asarray(b.column(i)) for i in range(5)]
        part, key, block, flipped, fp = cols
        fp = fp.view("u8")
        if not len(fp):
            continue
        new = np.flatnonzero((np.diff(part) != 0) | (np.diff(key) != 0) | (np.diff(block) != 0)) + 1
        starts = np.concatenate([[0], new])
        stops = np.concatenate([new, [len(fp)]])
        n_index = np.add.reduceat((~flipped).astype("int64"), starts)
        out = []
        carried = held_key == (part[0], key[0], block[0])
        size = stops - starts
        pairs = n_index * size
        small = (pairs > 0) & (size > 1) & (pairs <= 4096)
        if carried:
            small[0] = False
        if small.any():
            s, i, z = starts[small], n_index[small], size[small]
            many = i * z
            run = np.repeat(np.arange(len(s)), many)
            at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            left, right = fp[s[run] + at // z[run]], fp[s[run] + at % z[run]]
            good = (np.bitwise_count(left ^ right) <= max_distance) & (left != right)
            out.append((left[good], right[good]))
        big = np.flatnonzero((pairs > 4096) & ~small).tolist()
        for r in ([0] if carried and 0 not in big else []) + big:
            index = fp[starts[r]:starts[r] + n_index[r]]
            if r == 0 and carried:
                index = np.concatenate([held, index])
            out += _spanning(index, fp[starts[r]:stops[r]], max_distance)
        last = fp[starts[-1]:starts[-1] + n_index[-1]]
        held = np.concatenate([held, last]) if carried and len(starts) == 1 else last.copy()
        held_key = (part[-1], key[-1], block[-1])
        if out:
            a, c = (np.concatenate(x) for x in zip(*out))
            low, high = np.minimum(a, c), np.maximum(a, c)
            pair = np.unique(np.stack([low, high]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pair[0].view("i8")), pa.array(pair[1].view("i8"))],
                                             names=["a", "b"])


def _spanning(index, probes, max_distance: int) -> list:
    """Links that connect what the pairs index x probes connect: each member with its smallest linked label."""
    import numpy as np

    out, top = [], np.uint64(2**64 - 1)
    label = index.copy()
    for at in range(0, len(probes), 512):
        probe = probes[at:at + 512]
        near = np.bitwise_count(index[:, None] ^ probe[None, :]) <= max_distance
        rows, cols = near.any(axis=1), near.any(axis=0)
        near, probe = near[np.ix_(rows, cols)], probe[cols]
        if not probe.size:
            continue
        mine, theirs = label[rows], probe.copy()
        while True:
            t = np.minimum(theirs, np.where(near, mine[:, None], top).min(axis=0))
            m = np.minimum(mine, np.where(near, t[None, :], top).min(axis=1))
            if (t == theirs).all() and (m == mine).all():
                break
            mine, theirs = m, t
        moved = mine != label[rows]
        out += [(index[rows][moved], mine[moved]), (label[rows][moved], mine[moved]), (probe, theirs)]
        label[rows] = mine
    return [(a[a != b], b[a != b]) for a, b in out]


def link_edges(distinct: DataFrame, max_distance: int = 4, block: int = 4096) -> DataFrame:
    """``distinct`` (fp, each once, materialised) -> (a, b) links that span all classes."""
    import numpy as np

    spark = distinct.sparkSession
    n = distinct.count()
    some = distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    plan = allocate(np.array([r[0] for r in some], "i8").view("u8"), n, max_distance)

    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x

    own = [(p, signed(m)) for p, (m, _) in enumerate(plan)]
    probes = [(p, signed(m), signed(f)) for p, (m, t) in enumerate(plan) for f in flips(m, t)]
    # The probe list depends on the plan alone; as a literal it is part of the projection.
    literal = F.from_json(F.lit(str([list(p) for p in probes])), "array<array<long>>")
    rows = distinct.select("fp", F.explode(literal).alias("x")).select(
        F.col("x")[0].cast("int").alias("part"), F.col("fp").bitwiseAND(F.col("x")[1]).bitwiseXOR(F.col("x")[2]).alias("key"),
        (F.col("x")[2] != 0).alias("flipped"), "fp")
    index = F.array(*(F.struct(F.lit(p).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for p, m in own))
    hot = pin(distinct.select(F.explode(index).alias("x")).groupBy("x.part", "x.key")
              .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
              .select("part", "key", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    if hot.isEmpty():
        rows = rows.withColumn("block", F.lit(0))
    else:  # index rows go to one block of a hot key, probes visit each
        joined = rows.join(hot, ["part", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        home = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        visits = joined.select("part", "key", "fp", "flipped", home.alias("home"),
                               F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        rows = visits.withColumn("flipped", F.col("flipped") | (F.col("home") != F.col("block")))
    parts = parts_for(spark, n * len(probes), 400_000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    return (rows.select("part", "key", "block", "flipped", "fp").repartition(parts, "part", "key", "block")
            .sortWithinPartitions("part", "key", "block", "flipped", "fp")
            .mapInArrow(lambda batches: _links(batches, max_distance), "a long, b long"))


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", words_per_shingle: int = 4,
            max_distance: int = 4, seed: int = 42, block: int = 4096) -> DataFrame:
    """(key, fp, text_hash, component, component_id) of every row.

    ``component`` names the class by a fingerprint; ``component_id`` is its smallest key.
    """
    prints = pin(fingerprints(docs, key, text, words_per_shingle, seed))
    distinct = pin(prints.groupBy("fp").agg(F.min(key).alias("low")))
    linked = components(link_edges(distinct, max_distance, block))
    named = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("component"))
    named = pin(named)
    lows = named.groupBy("component").agg(F.min("low").alias("component_id"))
    of_print = named.select("fp", "component").join(lows, "component")
    return prints.join(of_print, "fp").select(key, "fp", "text_hash", "component", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words_per_shingle: int = 4,
             max_distance: int = 4) -> DataFrame:
    """``docs`` with one row of each class: the smallest key, then the smallest text hash; repeated rows once."""
    classed = classes(docs, key, text, words_per_shingle, max_distance)
    # the least (key, text) of a class; null keys come last
    order = F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("k"), F.col("text_hash").alias("h"))
    winners = classed.groupBy("component").agg(F.min(order).alias("w")).select("w.k", "w.h").distinct()
    mine = docs.withColumn("__hash", F.xxhash64(text))
    kept = mine.join(winners, mine[key].eqNullSafe(winners["k"]) & (mine["__hash"] == winners["h"]), "left_semi")
    return kept.dropDuplicates([key, "__hash"]).drop("__hash")


def hex_fingerprint(fp):
    """16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
