"""Operator 11, trie of shared conversation prefixes by truncation peeling.

A conversation is its turns (role, text) in order of ``turn`` (nulls first); a prefix of
d turns is a node of depth d.  Each conversation becomes a chain of 16-byte digests, one
a turn, each made of the digest before it and of the turn, so equal digests stand for
equal prefixes.  Texts are hashed and counted where they are read and are never shuffled.

The trie is peeled from the longest conversation down.  A round of depth d takes the
conversations that end there and the nodes of the round before, cut by their last turn,
and groups them by what is left: that one aggregate finds the nodes of depth d and sums
members, children, leaves and saved tokens over their subtrees.  Each round is written to
the shared checkpoint folder.  Rows carry the digests of at most ``BLOCK`` turns; the ones
before are fetched by the smallest member when a block is used up, so work and shuffle grow
with the turns, not with the square of a conversation's length.  Aggregates are partial
before they shuffle, so a first turn that a third of all conversations share is one row a task.

There are as many rounds as the deepest node that is not in the tail: depths that fewer than
one in ``TAIL_SHARE`` conversations reach, as long as they hold at most ``TAIL_NODES`` turns
(that bounds the task), are peeled in the same way by one task.

Edge cases: a null ``role`` or ``text`` is empty; rows of null ``conv_id`` belong to no
conversation and are left out; turns of one number (ties) go by role, then by the SHA-256 of role
and text; a repeated row is one more turn; a conversation without turns is a member of the
root only; an empty table has no node, the root included; other columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairforge.llm.common import spill_table, text_or_empty
from pairforge.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
KEY, ENTRY, BLOCK = 16, 24, 32
TAIL_NODES, TAIL_SHARE = 65_536, 1_000
HOT_PARENTS = 10_000
IDS_PER_CHUNK = 65_536

#: path: digests (16 bytes) and words (8 bytes, big-endian) of the turns of one block, up to ``top``.
PATHS = "conv_id long, top int, ends boolean, path binary"
NODES = ("depth int, key binary, parent_key binary, conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, up binary")


def ranked_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, at`` (from 0 in the conversation), ``item`` (digest of role and text), ``words`` of the text."""
    role, text = text_or_empty("role"), text_or_empty("text")
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"),
        F.unhex(F.substring(F.sha2(told, 256), 1, 2 * KEY)).alias("item"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "item")
    return turns.select("conv_id", (F.row_number().over(order) - 1).alias("at"), "item", "words")


def as_they_are(turns: DataFrame) -> DataFrame:
    return turns.select("conv_id", F.lit(1).alias("part"), "at", "item", "words")


def rebuilt(turns: DataFrame, every: int = 20, heads: int = 4) -> DataFrame:
    """First h = crc32(conv_id) % ``heads`` turns of conversation c - c % ``every``, then c's own after its first h.

    Rows of part 0 come before those of part 1; part -1 is a mark that keeps a conversation without turns.
    A base conversation serves fewer than 2 * ``every`` others, so the join cannot run hot.
    """
    ids = turns.groupBy("conv_id").agg(F.lit(0).alias("at")).select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int").alias("h"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    own = turns.where(F.col("at") >= h).select("conv_id", F.lit(1).alias("part"), "at", "item", "words")
    first = (turns.where((F.col("conv_id") % every == 0) & (F.col("at") < heads - 1))
             .select(F.col("conv_id").alias("base"), "at", "item", "words"))
    head = ids.join(first, "base").where(F.col("at") < F.col("h")).select("conv_id", F.lit(0).alias("part"), "at", "item", "words")
    mark = ids.select("conv_id", F.lit(-1).alias("part"), F.lit(0).alias("at"), F.lit(None).cast("binary").alias("item"),
                      F.lit(0).cast("long").alias("words"))
    return own.unionByName(head).unionByName(mark)


def _chains(batches):
    """Turns in order of conversation -> its blocks of chained digests; holds one block at a time."""
    import pyarrow as pa

    conv, key, path, top, out = None, b"", bytearray(), 0, []

    def table():
        cols = list(zip(*out)) if out else [()] * 4
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.bool_(), pa.binary()))],
                                           names=["conv_id", "top", "ends", "path"])
        out.clear()
        return batch

    for b in batches:
        for c, item, words in zip(b.column(0).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist()):
            if c != conv:
                if conv is not None:
                    out.append((conv, top, True, bytes(path)))
                conv, key, path, top = c, b"", bytearray(), 0
            if item is None:
                continue
            if len(path) == ENTRY * BLOCK:
                out.append((conv, top, False, bytes(path)))
                path = bytearray()
            key = hashlib.sha256(key + item).digest()[:KEY]
            path += key + words.to_bytes(8, "big")
            top += 1
        if out:
            yield table()
    if conv is not None:
        out.append((conv, top, True, bytes(path)))
        yield table()


def paths(turns: DataFrame) -> DataFrame:
    """Blocks of every conversation, written once; ``turns``: conv_id, part, at, item, words."""
    ordered = turns.select("conv_id", "part", "at", "item", "words").repartition("conv_id").sortWithinPartitions("conv_id", "part", "at")
    # sorted by depth, so a round skips the row groups of other depths
    return spill_table(ordered.mapInArrow(_chains, PATHS).sortWithinPartitions("top"), "trie-paths")


def tail_start(lengths: dict[int, int], nodes: int = TAIL_NODES, share: int = TAIL_SHARE) -> int:
    """The depth below which one task peels: few conversations get there and ``nodes`` bounds their turns."""
    total, alive, tops = sum(lengths.values()), 0, sorted(lengths, reverse=True)
    for top, below in zip(tops, [*tops[1:], 0]):
        alive += lengths[top]
        if alive * share > total:
            return top
        room = min(top - below, nodes // alive)
        nodes -= room * alive
        if room < top - below:
            return top - room
    return 0


def _peel_tail(start: int):
    """Blocks of the conversations longer than ``start`` -> their nodes below that depth."""

    def run(batches):
        import pyarrow as pa

        blocks: dict[int, dict[int, bytes]] = {}
        ended: dict[int, list[int]] = {}
        for b in batches:
            for c, top, ends, path in zip(*(x.to_pylist() for x in b.columns)):
                for i in range(len(path) // ENTRY):
                    blocks.setdefault(c, {})[top - i] = path[len(path) - ENTRY * (i + 1):len(path) - ENTRY * i]
                if ends:
                    ended.setdefault(top, []).append(c)
        above: dict[bytes, list] = {}
        for d in range(max(ended, default=0), start, -1):
            now: dict[bytes, list] = {}
            came = [(c, 1, 0, 0, 0) for c in ended.get(d, ())] + [(n[0], n[1], 1, n[3], n[4]) for n in above.values()]
            for c, n, children, leaves, saved in came:
                node = now.setdefault(blocks[c][d][:KEY], [c, 0, 0, 0, 0])
                node[0] = min(node[0], c)
                for i, x in enumerate((n, children, leaves, saved), 1):
                    node[i] += x
            rows = []
            for key, node in now.items():
                own = blocks[node[0]]
                node[3] = node[3] or 1
                node[4] += (node[1] - 1) * int.from_bytes(own[d][KEY:], "big")
                up = None
                if d == start + 1:
                    first = (start - 1) // BLOCK * BLOCK if start else 0
                    up = b"".join(own[i] for i in range(first + 1, start + 1))
                rows.append((d, key, own[d - 1][:KEY] if d > 1 else b"", *node, up))
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=schema)
            above = now

    import pyarrow as pa

    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names = [x.split()[0] for x in NODES.split(", ")]
    schema = pa.schema([(x.split()[0], types[x.split()[1]]) for x in NODES.split(", ")])
    return run


def _last(path: Column) -> Column:
    """The digest of the last turn of a path; empty for the root."""
    return F.substr(path, F.greatest(F.octet_length(path) - ENTRY + 1, F.lit(1)), F.lit(KEY))


def _fetch(nodes: DataFrame, blocks: DataFrame, depth: int) -> DataFrame:
    """Nodes of ``depth`` whose block is used up, with the one before it, found by their smallest member."""
    before = blocks.where(F.col("top") == depth - 1).select("conv_id", F.col("path").alias("__before"))
    return nodes.join(before, "conv_id").withColumn("up", F.col("__before")).drop("__before")


def trie(blocks: DataFrame, tail_nodes: int = TAIL_NODES, tail_share: int = TAIL_SHARE) -> DataFrame:
    """Nodes (``NODES``) of the conversations in ``blocks``: one aggregate for each depth, deepest first."""
    spark = blocks.sparkSession
    base = scratch_path(spark, "trie-nodes")
    read = spark.read.schema(NODES)
    lengths = {r["top"]: r["count"] for r in blocks.where("ends").groupBy("top").count().collect()}  # one row a length
    if not lengths:
        return spark.createDataFrame([], NODES)
    start = tail_start(lengths, tail_nodes, tail_share)
    start += start > 0 and start % BLOCK == 0  # the tail's first nodes have their parent in the same block
    above = None
    if start < max(lengths):
        tail = blocks.where(F.col("top") > start).repartition(1).mapInArrow(_peel_tail(start), NODES)
        tail.write.parquet(f"{base}/tail")
        above = read.parquet(f"{base}/tail").where(F.col("depth") == start + 1)
    state = ("path", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    zero = F.lit(0).cast("long")
    for d in range(min(start, max(lengths)), -1, -1):
        ended = blocks.where(F.col("ends") & (F.col("top") == d)).select(
            "path", "conv_id", F.lit(1).cast("long").alias("n_convs"), zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens"))
        rows = ended if above is None else ended.unionByName(above.select(
            F.col("up").alias("path"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens"))
        met = rows.groupBy("path").agg(F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in state[2:]))
        words = F.coalesce(F.conv(F.hex(F.substr("path", F.octet_length("path") - 7, F.lit(8))), 16, 10).cast("long"), F.lit(0))
        leaf = F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("n_leaves"))
        short = F.substr("path", F.lit(1), F.greatest(F.octet_length("path") - ENTRY, F.lit(0)))
        nodes = met.select(F.lit(d).alias("depth"), _last(F.col("path")).alias("key"), "conv_id", "n_convs", "n_children",
                           leaf.cast("long").alias("n_leaves"),
                           (F.col("saved_tokens") + ((F.col("n_convs") - 1) * words if d else zero)).cast("long").alias("saved_tokens"), short.alias("up"))
        if d > 1 and d % BLOCK == 1:
            nodes = _fetch(nodes, blocks, d)
        parent = _last(F.col("up")) if d else F.lit(None).cast("binary")
        nodes = nodes.withColumn("parent_key", parent).select(*(x.split()[0] for x in NODES.split(", ")))
        nodes.write.parquet(f"{base}/{d}")
        above = read.parquet(f"{base}/{d}")
    return read.parquet(f"{base}/*")


def _id_texts(batches):
    """Rows in order of (key, conv_id) -> comma-joined ids in chunks, with the first id of each."""
    import pyarrow as pa

    key, ids, out = None, [], []
    for b in batches:
        for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if k != key or len(ids) == IDS_PER_CHUNK:
                if ids:
                    out.append((key, ids[0], ",".join(map(str, ids))))
                key, ids = k, []
            ids.append(c)
        if len(out) > 1000:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], names=["key", "first", "ids"])
            out = []
    if ids:
        out.append((key, ids[0], ",".join(map(str, ids))))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], names=["key", "first", "ids"])


def _digests(batches):
    """Chunks in order of (key, first id) -> the SHA-256 of a key's whole list, streamed."""
    import pyarrow as pa

    key, sha, out = None, None, []
    for b in batches:
        for k, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
            if k != key:
                if sha:
                    out.append((key, sha.hexdigest()))
                key, sha = k, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.binary(), pa.string()))], names=["key", "ends_sha256"])
            out = []
    if sha:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([sha.hexdigest()])], names=["key", "ends_sha256"])


def ends_digests(blocks: DataFrame) -> DataFrame:
    """``key, ends_sha256``: of the ascending ids of the conversations that end at a node, joined by commas.

    Ids are sorted over all tasks by (node, id), so one node's many ids are spread; what one task
    hashes for such a node is its chunks of ids, one after another.
    """
    ends = blocks.where("ends").select(_last(F.col("path")).alias("key"), "conv_id")
    chunks = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(_id_texts, "key binary, first long, ids string")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digests, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, rebuild=rebuilt, tail_nodes: int = TAIL_NODES, tail_share: int = TAIL_SHARE) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``rebuild`` makes the conversations from ranked turns; ``as_they_are`` takes them unchanged.
    Parents of over 1 in ``HOT_PARENTS`` nodes are looked up by broadcast (there are fewer than
    ``HOT_PARENTS`` of them), all others by a join in which no key holds more rows than that.
    """
    blocks = paths(rebuild(spill_table(ranked_turns(conversations), "trie-turns")))
    nodes = trie(blocks, tail_nodes, tail_share)
    total = nodes.count()
    parents = nodes.where("n_children > 0").select(F.col("key").alias("__parent"), F.col("conv_id").alias("__conv"), "n_children")
    hot = F.col("n_children") * HOT_PARENTS > total
    broad = F.broadcast(parents.where(hot).select(F.col("__parent").alias("__hot"), F.col("__conv").alias("__hot_conv")))
    placed = nodes.join(broad, F.col("parent_key") == F.col("__hot"), "left")
    # a node that has its parent already goes by its own key, so the hot parent's children spread
    placed = placed.withColumn("__by", F.when(F.col("__hot").isNotNull(), F.col("key")).otherwise(F.col("parent_key")))
    placed = placed.join(parents.where(~hot).drop("n_children"), F.col("__by") == F.col("__parent"), "left")
    parent = F.when(F.col("__hot").isNotNull(), F.col("__hot_conv")).otherwise(F.col("__conv"))
    out = placed.select("key", "conv_id", F.col("depth").cast("long").alias("depth"), parent.alias("parent_conv_id"), "n_convs",
                        "n_children", "n_leaves", "saved_tokens").join(ends_digests(blocks), "key", "left")
    none = hashlib.sha256(b"").hexdigest()
    return out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(none))).drop("key")
