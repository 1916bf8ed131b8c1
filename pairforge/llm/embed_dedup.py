"""Operator 7, embedding near-dedup by sorted projection passes.

Equal vectors are one row from the start.  In each pass every distinct vector gets a
key of concatenated random hashes (signs of random projections, fixed by the seed,
the pass and the dimension).  All passes are ordered lexicographically at once by
(pass, dimension, key, vector) and numbered without a one-task window; blocks of
``block`` consecutive rows, each with the ``window`` rows before it, are compared: a
row with its ``window`` predecessors of the same pass.  Pairs whose cosine in double
precision reaches the threshold are verified links; a block emits a spanning forest of
them, and their union over all passes gives classes.

Windows miss more pairs the longer or the more crowded the table is.  So further passes
compare, with every other row of its key, each row that is not yet in the same class: no
window, so a pair is missed only if its keys differ in all passes.  Two vectors at the
threshold agree on a sign with p = 1 - arccos(threshold) / pi whatever lies around them,
so ceil(ln(1 - recall) / ln(1 - p ** k)) passes of k signs find a pair with at least
``recall``.  k is the cheapest by the row count and by the density of a sample's keys;
k = 0 compares all pairs, so small tables and those in one crowd are exact.  Keys with
many rows are compared by pairs of blocks.

Link counts are exact inside a class: members are compared block by block with the
other members of their class (never with vectors outside), so a window does not cap
the number of partners.  These comparisons also rest on verified cosines only.

Edge cases: null or zero vectors, and those with a null or non-finite component, link
with nothing, copies of themselves included; vectors of different dimensions never
link; equal vectors link with each other; repeated keys are separate vectors of one
name; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.llm.common import global_rank, parts_for, pin
from pairforge.llm.graph import components


def _valid(v):
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(v.isNotNull() & ok & F.exists(v, lambda x: x != 0), F.lit(False))


def _unit(column):
    """Rows of a list column as unit vectors in double precision, by dimension: (rows, matrix)."""
    import numpy as np

    sizes = np.asarray(column.value_lengths().fill_null(0))
    flat = np.asarray(column.flatten(), "f8")
    ends = np.cumsum(sizes)
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        m = flat[(ends[rows] - d)[:, None] + np.arange(d)]
        m = m / np.abs(m).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
        yield rows, m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _keys(batches, passes: int, bits: int, seed: int):
    """The other columns, the dimension and one key of ``bits`` signs for each pass."""
    import numpy as np
    import pyarrow as pa

    planes: dict[int, np.ndarray] = {}
    weight = 1 << np.arange(bits - 1, -1, -1, dtype="int64")
    for b in batches:
        out = np.zeros((b.num_rows, passes), "int64")
        dim = np.zeros(b.num_rows, "int32")
        for rows, m in _unit(b.column("vector")):
            d = m.shape[1]
            if d not in planes:
                planes[d] = np.random.default_rng([seed, d]).standard_normal((d, passes * bits))
            step = max(1, 480 // max(1, bits))  # passes at once: bounds the signs in memory
            for at in range(0, passes, step):
                some = planes[d][:, at * bits:(at + step) * bits]
                out[rows, at:at + step] = (m @ some > 0).reshape(len(rows), min(step, passes - at), bits) @ weight
            dim[rows] = d
        others = [c for c in b.schema.names if c != "vector"]
        yield pa.RecordBatch.from_arrays(
            [*map(b.column, others), pa.array(dim), pa.array(list(out), pa.list_(pa.int64()))], names=[*others, "dim", "keys"])


def _windows(window: int, threshold: float):
    def run(t):
        import numpy as np
        import pyarrow as pa

        t = t.combine_chunks().sort_by("rank")
        pas, dim, rank, ids = (np.asarray(t.column(c)) for c in ("pass", "dim", "rank", "id"))
        halo = np.asarray(t.column("halo"))
        found = []
        for rows, m in _unit(t.column("vector").chunk(0)):
            for step in range(1, window + 1):
                x, y = rows[step:], rows[:-step]
                near = (pas[x] == pas[y]) & (rank[x] - rank[y] == step) & ~halo[x]
                i = np.flatnonzero(near)
                if len(i):
                    cos = np.einsum("ij,ij->i", m[i + step], m[i])
                    i = i[cos >= threshold]
                    found.append((ids[x[i]], ids[y[i]]))
        a = np.concatenate([f[0] for f in found]) if found else np.zeros(0, "i8")
        b = np.concatenate([f[1] for f in found]) if found else np.zeros(0, "i8")
        pair = _forest(np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1))
        return pa.table({"a": pair[0], "b": pair[1]})

    return run


def _forest(pairs):
    """Those of a block's verified pairs that join two parts: fewer than its rows, with the same classes."""
    import numpy as np

    up: dict[int, int] = {}

    def top(x):
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    kept = []
    for i, (a, b) in enumerate(pairs.T.tolist()):
        a, b = top(a), top(b)
        if a != b:
            up[a] = b
            kept.append(i)
    return pairs[:, np.array(kept, "int64")]


def passes_for(bits: int, threshold: float, recall: float) -> int:
    """Passes of ``bits`` signs after which a pair at ``threshold`` has shared a key with probability ``recall``."""
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return 1 if agree >= recall else math.ceil(math.log(1 - recall) / math.log1p(-agree))


def cheapest_bits(dim, key, cls, bits: int, n: int, threshold: float, recall: float, block: int) -> int:
    """Signs of a key that cost least for ``n`` rows of which ``dim``, ``key`` (``bits`` signs) and ``cls`` are a sample.

    Costs are counted in cosines; a row sent to a block costs about as much as 1,500 of them.
    The sample steers the cost only: the number of passes keeps the recall for any k.
    """
    import numpy as np

    def sizes(*columns):
        return np.unique(np.stack(columns), axis=1, return_counts=True)[1]

    scale, cost = n / max(1, len(key)), []
    for k in range(bits + 1):
        prefix = key >> (bits - k)
        rows, same = sizes(dim, prefix), sizes(dim, prefix, cls)
        pairs = scale * scale * ((rows * (rows - 1)).sum() - (same * (same - 1)).sum()) / 2
        sent = (scale * rows * np.ceil(scale * rows / block)).sum()
        cost.append(passes_for(k, threshold, recall) * (1500 * sent + pairs))
    return int(np.argmin(cost))


def _crossings(threshold: float):
    """Classes joined by links between block ``x`` and block ``y`` of one key: a spanning forest of them."""

    def run(t):
        import numpy as np
        import pyarrow as pa

        t = t.combine_chunks().sort_by("cls")
        names, cls = np.unique(np.asarray(t.column("cls")), return_inverse=True)
        left, right = np.asarray(t.column("left")), np.asarray(t.column("right"))
        found = [np.zeros((2, 0), "int64")]
        for rows, m in _unit(t.column("vector").chunk(0)):
            x, every = np.flatnonzero(left[rows]), np.flatnonzero(right[rows])
            for at in range(0, len(x), 1024):
                part, y = x[at:at + 1024], every
                a = cls[rows[part]]
                if a[0] == a[-1]:  # one class (rows are in its order) has no news of itself
                    y = y[cls[rows[y]] != a[0]]
                b = cls[rows[y]]
                i, j = np.nonzero((m[part] @ m[y].T >= threshold) & (a[:, None] != b[None, :]))
                code = np.unique(np.maximum(a[i], b[j]) * len(names) + np.minimum(a[i], b[j]))
                found.append(_forest(np.stack([code // len(names), code % len(names)])))
        pair = _forest(np.concatenate(found, axis=1))
        return pa.table({"a": names[pair[0]], "b": names[pair[1]]})

    return run


def _missed(known: DataFrame, threshold: float, recall: float, bits: int, block: int, seed: int, sample: int = 65_536) -> DataFrame:
    """Links (a, b) between classes of ``known`` (id, cls, vector; ids are ranks by a hash, so the first are a sample)."""
    spark, n = known.sparkSession, known.count()
    schema = "id long, cls long, dim int, keys array<long>"
    pilot = (known.where(F.col("id") < sample).mapInArrow(lambda it: _keys(it, 1, bits, seed + 1), schema)
             .select("dim", F.col("keys")[0].alias("key"), "cls").toArrow())
    k = cheapest_bits(*(c.to_numpy() for c in pilot.columns), bits, n, threshold, recall, block)
    passes = passes_for(k, threshold, recall)
    keyed = known.mapInArrow(lambda it: _keys(it, passes, k, seed + 2), schema)
    rows = pin(keyed.select("id", "cls", "dim", F.posexplode("keys").alias("pass", "key")))
    of = ["pass", "dim", "key"]
    # a key all of one class has nothing to tell
    split = rows.groupBy(*of).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("n"), F.min("cls").alias("low"),
                                  F.max("cls").alias("high")).where("low < high").drop("low", "high")
    own = F.pmod(F.xxhash64("id"), F.col("n")).cast("int")
    dealt = rows.join(split, of).select("id", *of, own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
    sent = dealt.select("id", *of, F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own")
    sent = sent.join(known, "id").select(*of, "x", "y", "cls", "vector", (F.col("own") == F.col("x")).alias("left"),
                                         (F.col("own") == F.col("y")).alias("right"))
    return sent.groupBy(*of, "x", "y").applyInArrow(_crossings(threshold), "a long, b long")


def _degrees(threshold: float):
    """One class block: copies linked to each vector of block ``x`` among those of block ``y``."""

    def run(t):
        import numpy as np
        import pyarrow as pa

        t = t.combine_chunks()
        ids, copies = np.asarray(t.column("id")), np.asarray(t.column("copies"))
        left, right = np.asarray(t.column("left")), np.asarray(t.column("right"))
        degree = np.zeros(len(ids), "int64")
        for rows, m in _unit(t.column("vector").chunk(0)):
            x, y = np.flatnonzero(left[rows]), np.flatnonzero(right[rows])
            for at in range(0, len(x), 1024):
                part = x[at:at + 1024]
                near = (m[part] @ m[y].T >= threshold) & (ids[rows[part]][:, None] != ids[rows[y]][None, :])
                degree[rows[part]] = near @ copies[rows[y]]
        hit = np.flatnonzero(degree)
        return pa.table({"id": ids[hit], "degree": degree[hit]})

    return run


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.9,
                    passes: int = 12, bits: int = 40, window: int = 24, block: int = 4096, seed: int = 7,
                    recall: float = 0.999) -> DataFrame:
    """(key, n_links, component_id, kept) of every row; a link is found with probability ``recall`` at least."""
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    kind = "array<float>" if vectors.schema[vector].dataType == T.ArrayType(T.FloatType()) else "array<double>"  # half the bytes
    v = vectors.select(F.col(key).alias("__key"), F.col(vector).cast(kind).alias("vector"))
    v = pin(v.withColumn("ok", _valid(F.col("vector"))))
    good = v.where("ok")
    # equal vectors meet in one row; its id is a rank, so names of any kind will do
    distinct = good.groupBy("vector").agg(F.count(F.lit(1)).alias("copies"), F.min("__key").alias("low"))
    distinct = distinct.withColumn("hash", F.xxhash64("vector"))
    n = good.count()
    parts = parts_for(spark, n, 200_000)
    distinct = pin(global_rank(distinct, ["hash", "vector"], "id", parts))
    schema = "id long, dim int, keys array<long>"
    keyed = distinct.select("id", "vector").mapInArrow(lambda it: _keys(it, passes, bits, seed), schema)
    rows = keyed.select("id", "dim", F.posexplode("keys").alias("pass", "key"))
    ranked = global_rank(rows, ["pass", "dim", "key", "id"], "rank", parts_for(spark, n * passes, 400_000))
    home = F.floor(F.col("rank") / block)
    near_end = F.col("rank") % block >= block - window
    blocks = F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))
    placed = ranked.select("pass", "dim", "rank", "id", home.alias("home"), F.explode(blocks).alias("block"))
    placed = placed.withColumn("halo", F.col("home") != F.col("block")).drop("home")
    edges = (placed.join(distinct.select("id", "vector"), "id").groupBy("block")
             .applyInArrow(_windows(window, threshold), "a long, b long"))
    near = components(edges)
    known = distinct.select("id", "vector").join(near.withColumnRenamed("node", "id"), "id", "left")
    known = pin(known.select("id", F.coalesce("component", "id").alias("cls"), "vector"))
    joined = components(_missed(known, threshold, recall, bits, block, seed)).withColumnRenamed("node", "cls")
    moved = known.select("id", "cls").join(joined, "cls", "left").select("id", F.coalesce("component", "cls").alias("component"))
    moved = moved.where("id <> component")  # a class is named by its smallest id
    linked = moved.withColumnRenamed("id", "node").union(
        moved.select(F.col("component").alias("node"), "component").distinct())
    members = pin(distinct.join(linked.withColumnRenamed("node", "id"), "id"))
    # Degrees inside a class, by pairs of blocks of at most about ``block`` members
    split = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / (block / 2)).cast("int").alias("n"))
    dealt = members.join(split, "component").select(
        "component", "id", "copies", "vector", "n", F.pmod(F.xxhash64("id"), F.col("n")).cast("int").alias("own"))
    every = F.sequence(F.lit(0), F.col("n") - 1)
    both = F.concat(F.transform(every, lambda y: F.struct(F.col("own").alias("x"), y.alias("y"))),
                    F.transform(F.filter(every, lambda x: x != F.col("own")), lambda x: F.struct(x.alias("x"), F.col("own").alias("y"))))
    sent = dealt.select("component", "id", "copies", "vector", "own", F.explode(both).alias("p")).select(
        "component", F.col("p.x").alias("x"), F.col("p.y").alias("y"), "id", "copies", "vector",
        (F.col("own") == F.col("p.x")).alias("left"), (F.col("own") == F.col("p.y")).alias("right"))
    degrees = (sent.groupBy("component", "x", "y").applyInArrow(_degrees(threshold), "id long, degree long")
               .groupBy("id").agg(F.sum("degree").alias("degree")))
    lows = members.groupBy("component").agg(F.min("low").alias("component_low"))
    of = (distinct.join(members.select("id", "component"), "id", "left").join(lows, "component", "left")
          .join(degrees, "id", "left"))
    of = of.select("vector", F.coalesce("component_low", "low").alias("__component"),
                   (F.coalesce("degree", F.lit(0)) + F.col("copies") - 1).cast("long").alias("__links"))
    got = good.join(of, "vector").select("__key", "__links", "__component")
    lone = v.where(~F.col("ok")).select("__key", F.lit(0).cast("long").alias("__links"), F.col("__key").alias("__component"))
    return got.union(lone).select(F.col("__key").alias(key), F.col("__links").alias("n_links"),
                                  F.col("__component").alias("component_id"),
                                  F.col("__key").eqNullSafe(F.col("__component")).alias("kept"))
