"""Operator 5, sharding by best-fit-decreasing bin packing of indivisible groups.

Groups (equal texts) go to a fixed number of shards by the law ``bytes``: shard
sizes near equal.  Groups sorted by size, largest first, each enter the shard with
the least remaining capacity that still holds them, found in a balanced tree.

Every group is packed, at any input size.  The packing only needs how many groups there
are of each size (at most the square root of twice the total bytes, read as a stream): while a shard
is the tightest that holds a size it takes as many groups of it as fit, in one step.  A shard
that is left and entered again has less than half the room each time, so the shard changes
along the sorted groups at most about 2 * shards * log2(total) times.  Each change is a bound (size, hash
of the group's text), the hash of a bound inside a size being found by a distributed rank of the groups of
such sizes.  A row's shard follows from its group's size and hash by these few bounds.

A row knows its own size; that of its group comes by a broadcast join for groups of more than
``total / grain`` bytes (fewer than ``grain``) and by a shuffled join for other groups of
several rows, where no key holds more than that.

A group over the remaining mean opens a shard of its own; the capacity of the
others follows from what is left.  An item that fits no shard enters the emptiest.

Edge cases: null and empty texts are one group of rows of size 1; repeated rows
keep separate slots in the same shard; ties in size go by hash; an empty table
gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.llm.common import global_rank, part_bases, parts_for, pin, text_or_empty


def best_fit_runs(runs, total: int, shards: int):
    """Steps (size, groups, shard) of best-fit decreasing over ``runs`` of (size, groups), sizes descending.

    The same as one group after another.  Capacity: what makes the shards equal.
    """
    left, open_, taken = total, shards, 0
    rooms: list[tuple[int, int]] = []  # balanced by order: (remaining capacity, shard)
    for size, n in runs:
        while n:
            if not rooms:
                if open_ > 1 and size * open_ >= left:  # larger than an equal share: a shard of its own
                    yield size, 1, taken
                    taken, open_, left, n = taken + 1, open_ - 1, left - size, n - 1
                    continue
                rooms = [(-(-left // open_), taken + i) for i in range(open_)]
            at = bisect_left(rooms, (size, -1))
            fits = at < len(rooms)
            room, shard = rooms.pop(at if fits else -1)
            k = min(n, room // size) if fits else 1
            yield size, k, shard
            insort(rooms, (room - k * size, shard))
            n -= k


def best_fit_decreasing(sizes: list[int], shards: int) -> list[int]:
    """Shard of each item; ``sizes`` descend."""
    return [shard for _, k, shard in best_fit_runs(((s, 1) for s in sizes), sum(sizes), shards) for _ in range(k)]


def _bounds(groups: DataFrame, total: int, shards: int) -> list[tuple[int, bytes, int]]:
    """(-bytes, least hash, shard) where the shard changes along the groups by size and hash, in that order."""
    spark = groups.sparkSession
    counts = groups.groupBy("bytes").count().orderBy(F.desc("bytes"))
    number: dict[int, int] = {}

    def runs():
        for r in counts.toLocalIterator():
            number.clear()
            number[r["bytes"]] = r["count"]
            yield r["bytes"], r["count"]

    changes, inside, before, size, at = [], {}, None, None, 0
    for s, k, shard in best_fit_runs(runs(), total, shards):
        if s != size:
            size, at = s, 0
        if shard != before:
            changes.append((s, at, shard))
            if at:
                inside[s] = number[s]
        before, at = shard, at + k
    first, ranks = 0, {}  # ranks among the groups of the sizes that a change lies inside
    for s in sorted(inside):
        ranks.update({first + i: (s, i) for t, i, _ in changes if t == s and i})
        first += inside[s]
    hashes = {}
    if ranks:
        sizes = spark.createDataFrame([(s,) for s in inside], "bytes long")
        mine = groups.join(F.broadcast(sizes), "bytes").select("bytes", "__group")
        ranked = global_rank(mine, ["bytes", "__group"], "__rank", parts_for(spark, first, 1_000_000))
        wanted = spark.createDataFrame([(r,) for r in ranks], "__rank long")
        hashes = {ranks[r["__rank"]]: bytes(r["__group"]) for r in ranked.join(F.broadcast(wanted), "__rank").collect()}
    return [(-s, hashes[s, i] if i else b"", shard) for s, i, shard in changes]


def assign_shards(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 8,
                  grain: int = 32_768) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    spark = docs.sparkSession
    body = text_or_empty(text)
    rows = pin(docs.select(
        F.col(key), (F.octet_length(body) + F.lit(1)).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        F.unhex(F.sha2(body, 256)).alias("__group")))
    groups = pin(rows.groupBy("__group").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    bounds = _bounds(groups, total, shards)
    large = F.col("bytes") * grain > F.lit(total)
    hot = groups.where(large).select("__group", F.col("bytes").alias("__hot"))  # fewer than ``grain`` rows
    several = groups.where(~large & (F.col("rows") > 1)).select(F.col("__group").alias("__same"), F.col("bytes").alias("__all"))
    # rows of hot groups go anywhere: their key is longer than any group's
    spread = F.when(F.col("__hot").isNull(), F.col("__group")).otherwise(
        F.concat("__group", F.encode(F.monotonically_increasing_id().cast("string"), "UTF-8")))
    sized = (rows.join(F.broadcast(hot), "__group", "left").withColumn("__join", spread)
             .join(several, F.col("__join") == F.col("__same"), "left"))
    out = sized.select(key, "size", "text_crc32", "__group", F.coalesce("__hot", "__all", "size").alias("__bytes"))
    schema = T.StructType([*out.schema.fields[:3], T.StructField("shard", T.IntegerType()),
                           T.StructField("__part", T.IntegerType()), T.StructField("__at", T.LongType())])
    starts, targets = [b[:2] for b in bounds], [b[2] for b in bounds]

    def number(batches):
        from bisect import bisect_right

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), np.zeros(shards, "int64")
        for b in batches:
            keys = zip(b.column(4).to_pylist(), b.column(3).to_pylist())
            shard = np.array([targets[bisect_right(starts, (-n, g)) - 1] for n, g in keys], "int32")
            at = np.empty(len(shard), "int64")
            for s in range(shards):
                mine = shard == s
                n = int(mine.sum())
                at[mine] = seen[s] + np.arange(n)
                seen[s] += n
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(shard), pa.array(np.full(len(shard), part, "int32")), pa.array(at)],
                names=[*b.schema.names[:3], "shard", "__part", "__at"])

    numbered = pin(out.mapInArrow(number, schema))
    bases = part_bases(numbered, ("shard",))  # partitions x shards rows
    return numbered.join(F.broadcast(bases), ["shard", "__part"]).select(
        key, "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("__base") + F.col("__at")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
