"""Operator 2, suffix-array dedup: blockwise suffix sorting with a difference cover.

A byte is removed if a string of ``length`` bytes that covers it also starts earlier
in the corpus (smaller key, or same document, earlier start).  Strings are judged on
the input and never cross documents.

Suffix buckets.  A suffix is put in the bucket of its anchor: the smallest hash among
the ``k``-byte strings inside its first ``length`` bytes (leftmost in ties).  Suffixes
that agree on ``length`` bytes have the same anchor at the same distance, so they meet
in one bucket; a run of consecutive suffixes with one anchor travels as one context of
at most ``2 * length - k`` bytes instead of one string per suffix.

1. Texts are dealt once, in chunks of a few MB, to a bucketed table; every later step
   joins its findings to that table by chunk without moving the text again.
2. Each chunk sends its distinct anchors (five bytes each) to hash buckets.  Anchors
   seen once in the corpus cannot start a repeat and are dropped.
3. Contexts of the remaining anchors are first aggregated by a 128-bit digest: of equal
   contexts the first holder stands for all, the others lose all their suffixes.  So a
   passage that a third of the documents hold is one context before anything is sorted.
4. Of buckets with two or more distinct contexts, suffixes whose rolling hash is the only
   one in their bucket are set aside.  The others are sorted, one block of whole buckets
   at a time, by the first 64 bytes of each suffix.  Longer ties that do not all agree are
   resolved by ranks of the cover sample (positions whose residue modulo ``V`` lies in a
   perfect difference set), computed once per block: for two suffixes i and j some d < V has i + d and j + d
   in the sample, and their ranks decide.  Neighbours that agree on ``length`` bytes form
   a class, and all but its first suffix are marked.
5. An anchor with more than ``hot`` distinct contexts does not fit one block; its
   suffixes are aggregated one by one by content instead (pre-aggregated before the
   shuffle), which gives the same first holders.

Edge cases: a null text is empty and texts under ``length`` bytes lose nothing; rows
with equal keys come in the order in which they are read, so a repeated row loses what
its first copy holds; null keys come before all others; an empty table gives an empty
one; columns of other names are kept by ``remove_repeats``, whatever they are called.
Keys must be integers.
"""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import checkpoint_dir, pin, spill_table, text_batches

#: A perfect difference set modulo 57: each residue but 0 is one difference of two members.
V, COVER = 57, (0, 1, 3, 13, 32, 36, 43, 52)

LOSES, FIRST, CONTESTED, HOT = 0, 1, 2, 3


def words_at(data: bytes):
    """The 8 bytes at each position as little-endian integers (zeros after the end)."""
    import numpy as np

    n = len(data)
    padded = data + bytes(16 + -n % 8)
    out = np.empty(n, "<u8")
    for o in range(min(8, n)):
        view = np.frombuffer(padded, "<u8", offset=o, count=(len(padded) - o) // 8)
        mine = out[o::8]
        mine[:] = view[:len(mine)]
    return out


def _segments(offsets, size: int):
    """Bounds of runs of whole documents of about ``size`` bytes."""
    import numpy as np

    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        yield offsets[at:to + 1]
        at = to


def anchors(data: bytes, offsets, length: int, k: int):
    """(anchor position, first suffix, number of suffixes, anchor hash) of each run of suffixes.

    ``offsets`` are the documents' bounds in ``data``.
    """
    import numpy as np

    found = []
    for own in _segments(np.asarray(offsets, "int64"), 1 << 17):  # small enough for a core's cache
        a, first, many, h = _anchors(data[own[0]:own[-1]], own - own[0], length, k)
        found.append((a + own[0], first + own[0], many, h))
    if not found:
        z = np.zeros(0, "int64")
        return z, z, z, z.astype("u8")
    return tuple(np.concatenate(x) for x in zip(*found))


def _anchors(data: bytes, offsets, length: int, k: int):
    import numpy as np

    w, n = length - k + 1, len(data)
    valid = np.zeros(n + 1, "int8")  # suffixes with ``length`` bytes before their document ends
    starts, lasts = offsets[:-1], offsets[1:] - length + 1
    long = lasts > starts
    if not long.any():
        z = np.zeros(0, "int64")
        return z, z, z, z.astype("u8")
    valid[starts[long]] += 1
    valid[lasts[long]] -= 1
    word = words_at(data)
    m = n - k + 1
    h = word[:m] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    for at, c in [(s, 0xBF58476D1CE4E5B9 + 2 * s) for s in range(8, k - 8, 8)] + [(k - 8, 0x94D049BB133111EB)]:
        h += word[at:at + m]
        h *= np.uint64(c)
        h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    # 24 bits of the hash choose, the position below them makes the leftmost win
    key = np.full(-(-m // w) * w, np.uint64(2**64 - 1))
    np.bitwise_and(h, np.uint64(0xFFFFFF << 40), out=key[:m])
    key[:m] |= np.arange(m, dtype="u8")
    rows = key.reshape(-1, w)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(after[:n - length + 1], before[w - 1:w - 1 + n - length + 1])
    start = np.flatnonzero(np.cumsum(valid[:n - length + 1]))
    anchor = (low[start] & np.uint64((1 << 40) - 1)).astype("int64")
    first = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1])
    runs = np.diff(np.concatenate([first, [len(anchor)]]))
    a = anchor[first]
    return a, start[first], runs, h[a]


def _chunk_table(docs: DataFrame, key: str, text: str, chunk_bytes: int) -> tuple[DataFrame, str, int]:
    """Texts in chunks, dealt once into a bucketed table: (table, its name, bytes of text)."""
    spark = docs.sparkSession
    text_batches(spark)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held, size = [], 0

        def flush():
            t = pa.Table.from_batches(held).combine_chunks()
            rest = t.select(range(2, t.num_columns))
            texts = [x or b"" for x in t.column(1).to_pylist()]
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rest.schema) as writer:
                writer.write_table(rest)
            keys = t.column(0).to_pylist()
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([keys], pa.list_(pa.int64())),
                 pa.array([np.cumsum([0, *map(len, texts)])], pa.list_(pa.int64())),
                 pa.array([b"".join(texts)], pa.binary()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                names=["chunk", "keys", "offsets", "data", "rest"])

        for b in batches:
            for at in range(0, b.num_rows, 32):
                held.append(b.slice(at, 32))
                size += held[-1].column(1).nbytes
                if size >= chunk_bytes:
                    yield flush()
                    held, size, number = [], 0, number + 1
        if held:
            yield flush()

    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    rows = docs.select(F.col(key).cast("long").alias("__key"), F.col(text).cast("binary").alias("__text"), *others)
    chunks = rows.mapInArrow(run, "chunk long, keys array<long>, offsets array<long>, data binary, rest binary")
    # with fewer buckets than shuffle partitions a join would deal the texts anew
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    name = f"suffix_chunks_{uuid.uuid4().hex[:12]}"
    (chunks.repartition(buckets, "chunk").write.format("parquet").option("compression", "zstd")
     .bucketBy(buckets, "chunk").saveAsTable(name))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")  # a row is a chunk of a few MB
    t = spark.table(name)
    total = t.agg(F.sum(F.element_at("offsets", -1))).first()[0] or 0
    return t, name, total


def _join(chunks: DataFrame, found: DataFrame) -> DataFrame:
    """Findings (one row per chunk) go to the chunk's bucket; the text stays where it is."""
    return chunks.join(found.hint("shuffle_hash"), "chunk", "left")


def _by_chunk(found: DataFrame, name: str) -> DataFrame:
    cols = [c for c in found.columns if c != "chunk"]
    return found.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct(*cols))).alias(name))


def _slices(values, bits: int):
    """(bucket, from, to) of sorted 40-bit values by their top ``bits`` bits."""
    import numpy as np

    bucket = (values >> np.uint64(40 - bits)).astype("int64") if bits else np.zeros(len(values), "int64")
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(values)]])
    return [(int(bucket[s]), int(s), int(e)) for s, e in zip(cuts, cuts[1:]) if e > s]


def _send_anchors(batches, length, k, bits):
    """Each chunk's distinct anchor hashes, 5 bytes each, by bucket."""
    import numpy as np
    import pyarrow as pa

    for b in batches:
        for i in range(b.num_rows):
            _, _, _, h = anchors(b.column("data")[i].as_py(), b.column("offsets").slice(i, 1).flatten(), length, k)
            own = np.unique(h >> np.uint64(24))
            packed = own.view("u1").reshape(-1, 8)[:, :5]
            parts = _slices(own, bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array([b.column("chunk")[i].as_py()] * len(parts), pa.int64()),
                 pa.array([p[0] for p in parts], pa.int32()),
                 pa.array([packed[s:e].tobytes() for _, s, e in parts], pa.binary())], names=["chunk", "bucket", "sent"])


def _unpack5(blob):
    import numpy as np

    raw = np.frombuffer(blob, "u1").reshape(-1, 5)
    return np.pad(raw, ((0, 0), (0, 3))).view("<u8").ravel()


def _count_anchors(t):
    """One bucket: of each chunk's anchors, those that another chunk holds too, as bits."""
    import numpy as np
    import pyarrow as pa

    blobs = t.column("sent").to_pylist()
    sizes = [len(x) // 5 for x in blobs]
    values = _unpack5(b"".join(blobs))
    order = np.argsort(values, kind="stable")
    same = values[order][1:] == values[order][:-1]
    more = np.zeros(len(values), bool)
    more[order[1:][same]] = True
    more[order[:-1][same]] = True
    at = np.cumsum([0, *sizes])
    masks = [np.packbits(more[s:e]).tobytes() for s, e in zip(at, at[1:])]
    return pa.table({"chunk": t.column("chunk"), "bucket": t.column("bucket"), "size": pa.array(sizes, pa.int32()),
                     "mask": pa.array(masks, pa.binary())})


_RECORD = [("fp", "<u8"), ("d1", "<u8"), ("d2", "<u8"), ("key", "<i8")]


def _send_contexts(batches, length, k, bits):
    """Each chunk's repeated anchors, and the first holder in the chunk of each distinct context by bucket."""
    import numpy as np
    import pyarrow as pa
    from xxhash import xxh3_128_digest

    for b in batches:
        for i in range(b.num_rows):
            data = b.column("data")[i].as_py()
            offsets = np.asarray(b.column("offsets").slice(i, 1).flatten())
            a, first, many, h = anchors(data, offsets, length, k)
            fp = h >> np.uint64(24)
            own, inverse, count = np.unique(fp, return_inverse=True, return_counts=True)
            found = b.column("masks")[i].as_py() or []
            more = np.concatenate([np.unpackbits(np.frombuffer(m["mask"], "u1"), count=m["size"]) for m in found]) \
                if found else np.zeros(len(own), "u1")
            take = ((more != 0) | (count > 1))[inverse]
            a, first, many, fp = a[take], first[take], many[take], fp[take]
            view = memoryview(data)
            digest = np.frombuffer(b"".join(
                [xxh3_128_digest(view[s:s + n + length - 1], seed=int(p - s)) for p, s, n in
                 zip(a.tolist(), first.tolist(), many.tolist())]), "<u8").reshape(-1, 2)
            keys = b.column("keys").slice(i, 1).flatten().to_pylist()
            keys = np.array([-2**63 if x is None else x for x in keys], "i8")
            doc = np.searchsorted(offsets, a, side="right") - 1
            doc_key = keys[doc] if len(keys) else np.zeros(0, "i8")
            order = np.lexsort((a, doc_key, digest[:, 1], digest[:, 0], fp))
            f, d = fp[order], digest[order]
            lead = np.ones(len(f), bool)
            lead[1:] = (f[1:] != f[:-1]) | (d[1:] != d[:-1]).any(axis=1)
            sent = order[lead]  # sorted by anchor hash
            rec = np.empty(len(sent), _RECORD)
            rec["fp"], rec["d1"], rec["d2"], rec["key"] = fp[sent], digest[sent, 0], digest[sent, 1], doc_key[sent]
            parts = [{"bucket": p, "size": e - s, "sent": rec[s:e].tobytes()} for p, s, e in _slices(fp[sent], bits)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b.column("chunk")[i].as_py()], pa.int64()),
                 *(pa.array([x.astype("int32").tobytes()], pa.binary()) for x in (a, first, many, sent)),
                 pa.array([parts], pa.list_(pa.struct([("bucket", pa.int32()), ("size", pa.int32()),
                                                       ("sent", pa.binary())])))],
                names=["chunk", "anchor", "first", "many", "sent", "parts"])


def _rank_contexts(hot, t):
    """One bucket: a code for each sent context (see LOSES ... HOT)."""
    import numpy as np
    import pyarrow as pa

    blobs = t.column("sent").to_pylist()
    sizes = [len(x) // 32 for x in blobs]
    rec = np.frombuffer(b"".join(blobs), _RECORD)
    chunk = np.repeat(np.asarray(t.column("chunk")), sizes)
    order = np.lexsort((chunk, rec["key"], rec["d2"], rec["d1"], rec["fp"]))
    s = rec[order]
    new_fp = np.ones(len(s), bool)
    new_fp[1:] = s["fp"][1:] != s["fp"][:-1]
    lead = new_fp.copy()
    lead[1:] |= (s["d1"][1:] != s["d1"][:-1]) | (s["d2"][1:] != s["d2"][:-1])
    group = np.cumsum(new_fp) - 1
    contexts = np.bincount(group, weights=lead)[group] if len(s) else np.zeros(0)
    code = np.where(~lead, LOSES, np.where(contexts > hot, HOT, np.where(contexts > 1, CONTESTED, FIRST))).astype("u1")
    back = np.empty(len(s), "u1")
    back[order] = code
    at = np.cumsum([0, *sizes])
    return pa.table({"chunk": t.column("chunk"), "bucket": t.column("bucket"),
                     "codes": pa.array([back[x:y].tobytes() for x, y in zip(at, at[1:])], pa.binary()),
                     "hot": pa.array([bool((back[x:y] == HOT).any()) for x, y in zip(at, at[1:])], pa.bool_())})


def _facts(b, i):
    """(anchor, first, many, code of each kept anchor) of a chunk row joined with its findings."""
    import numpy as np

    blobs = [b.column(c)[i].as_py() for c in ("anchor", "first", "many", "sent")]
    a, first, many, sent = (np.frombuffer(x or b"", "<i4").astype("int64") for x in blobs)
    code = np.full(len(a), LOSES, "u1")
    found = b.column("codes")[i].as_py() or []
    code[sent] = np.frombuffer(b"".join(x["codes"] for x in found), "u1")
    return a, first, many, code


_CONTESTED = ("chunk long, bucket int, at array<int>, key array<long>, anchor array<long>, before array<int>, "
              "context array<binary>, gram array<binary>")


def _send_contested(batches, length, buckets):
    """A chunk's contested contexts, one row for each bucket they go to."""
    import zlib

    import numpy as np
    import pyarrow as pa

    for b in batches:
        for i in range(b.num_rows):
            a, first, many, code = _facts(b, i)
            data, offsets = b.column("data")[i].as_py(), np.asarray(b.column("offsets").slice(i, 1).flatten())
            keys = np.array([-2**63 if x is None else x for x in b.column("keys").slice(i, 1).flatten().to_pylist()], "i8")
            at = np.flatnonzero(code == CONTESTED)
            bucket = np.array([zlib.crc32(data[p:p + 16]) % buckets for p in a[at].tolist()], "int64")
            at = at[np.argsort(bucket, kind="stable")]
            bucket = np.sort(bucket)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(at)]])[:None if len(at) else 1]
            lists = pa.array(cuts, pa.int32())
            key = keys[np.searchsorted(offsets, a[at], side="right") - 1] if len(at) else keys[:0]

            def column(values, kind):
                return pa.ListArray.from_arrays(lists, pa.array(values, kind))

            yield pa.RecordBatch.from_arrays(
                [pa.array([b.column("chunk")[i].as_py()] * (len(cuts) - 1), pa.int64()),
                 pa.array(bucket[cuts[:-1]], pa.int32()), column(at, pa.int32()), column(key, pa.int64()),
                 column(a[at], pa.int64()), column(a[at] - first[at], pa.int32()),
                 column([data[s:s + n + length - 1] for s, n in zip(first[at].tolist(), many[at].tolist())], pa.binary()),
                 column([data[p:p + 16] for p in a[at].tolist()], pa.binary())],
                names=["chunk", "bucket", "at", "key", "anchor", "before", "context", "gram"])


def cover_table():
    """shift[r, s]: the least d for which r + d and s + d are both in the cover (modulo V)."""
    import numpy as np

    member = np.zeros(V, bool)
    member[list(COVER)] = True
    d = np.arange(V)
    both = member[(np.arange(V)[:, None, None] + d) % V] & member[(np.arange(V)[None, :, None] + d) % V]
    if not both.any(axis=2).all():
        raise AssertionError("not a difference cover")
    return both.argmax(axis=2), member


def _cover_ranks(word, positions, member, length: int):
    """Ranks, by ``length`` bytes, of the sampled positions that suffixes at ``positions`` can ask for."""
    import numpy as np

    n = len(word)
    asked = np.zeros(n + 1, "int32")
    np.add.at(asked, positions, 1)
    np.add.at(asked, positions + V, -1)
    at = np.flatnonzero(np.cumsum(asked)[:-1] > 0)
    sample = at[member[at % V]]
    depth = range(0, length, 8)
    by = np.lexsort([word[sample + o] for o in reversed(depth)])
    differs = np.zeros(len(by), bool)
    for o in depth:
        x = word[sample[by] + o]
        differs[1:] |= x[1:] != x[:-1]
    rank = np.zeros(n, "int32")
    rank[sample[by]] = np.cumsum(differs)
    return rank


def _resolve_ties(order, p, tie, word, length: int) -> None:
    """Put ties (numbered by ``tie``, in order) in the order of their cover ranks, in place.

    All ties are partitioned at once, three ways around one pivot each.
    """
    import numpy as np

    shift, member = cover_table()
    slots = np.flatnonzero(tie >= 0)
    part = tie[slots]
    rank = _cover_ranks(word, p[slots], member, length)
    x, own = p[slots], order[slots]
    while len(slots):
        heads = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1])
        sizes = np.diff(np.concatenate([heads, [len(part)]]))
        pivot = np.repeat(x[heads + sizes // 2], sizes)
        d = shift[pivot % V, x % V]
        side = np.sign(rank[x + d] - rank[pivot + d])
        again = np.argsort(part * 3 + side, kind="stable")
        x, own, side = x[again], own[again], side[again]
        label = np.concatenate([[0], np.cumsum((np.diff(part) != 0) | (np.diff(side) != 0))])
        go = (side != 0) & (np.bincount(label)[label] > 1)
        done = ~go
        order[slots[done]], p[slots[done]] = own[done], x[done]
        slots, part, x, own = slots[go], label[go], x[go], own[go]


def sort_suffixes(data: bytes, positions, groups, length: int, block: int = 1 << 20):
    """Order of the suffixes at ``positions`` by (group, first ``length`` bytes), as blocks of whole groups.

    Yields (indices in order, True where a suffix agrees with the one before on
    group and ``length`` bytes).  Suffixes that agree may come in any order.
    """
    import numpy as np

    word = np.concatenate([words_at(data).byteswap(), np.zeros(length + V + 72, "u8")])
    whole = np.argsort(groups, kind="stable")
    ends = np.concatenate([np.flatnonzero(np.diff(groups[whole])) + 1, [len(whole)]])

    def agree(x, y, start):
        """Same bytes from ``start`` up to ``length``?"""
        same = np.ones(len(x), bool)
        for o in range(start, length, 8):
            a, b = word[x + o], word[y + o]
            if o + 8 > length:
                cut = np.uint64(8 * (o + 8 - length))
                a, b = a >> cut, b >> cut
            same &= a == b
        return same

    start = 0
    while start < len(whole):
        stop = int(ends[max(np.searchsorted(ends, start + block, side="right") - 1, np.searchsorted(ends, start, side="right"))])
        mine = whole[start:stop]
        start = stop
        pos, group = positions[mine], groups[mine]
        order = np.lexsort([word[pos + o] for o in range(min(56, (length - 1) // 8 * 8), -8, -8)] + [group])
        p, g = pos[order], group[order]
        # (a word that reaches past ``length`` only orders suffixes that agree)
        near = g[1:] == g[:-1]
        tied = near & agree(p[1:], p[:-1], 0) if length <= 64 else near.copy()
        if length > 64:
            for o in range(0, 64, 8):
                tied &= word[p[1:] + o] == word[p[:-1] + o]
            agrees = tied.copy()
            agrees[tied] = agree(p[1:][tied], p[:-1][tied], 64)
            # ties that all agree are one class; the others need an order
            tie = np.concatenate([[0], np.cumsum(~tied)])
            mixed = np.bincount(tie[1:], weights=tied & ~agrees, minlength=tie[-1] + 1) > 0
            if mixed.any():
                _resolve_ties(order, p, np.where(mixed[tie], tie, -1), word, length)
                again = np.flatnonzero(mixed[tie[1:]] & tied)
                agrees[again] = agree(p[again + 1], p[again], 64)
        else:
            agrees = tied
        yield mine[order], np.concatenate([[False], agrees])


def _hash_repeats(data: bytes, positions, groups, length: int):
    """False where a suffix cannot agree with another of its group: its rolling hash is the only one."""
    import numpy as np

    base = 0x9E3779B97F4A7C15
    n = len(data)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(n, base, "u8"))
        sums = np.concatenate([np.zeros(1, "u8"), np.cumsum((np.frombuffer(data, "u1").astype("u8") + np.uint64(1)) * power)])
        back = np.cumprod(np.full(n, pow(base, -1, 1 << 64), "u8"))
        h = (sums[positions + length] - sums[positions]) * back[positions]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + groups.astype("u8") * np.uint64(0xBF58476D1CE4E5B9)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    out = np.zeros(len(h), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _sort_bucket(length, t):
    """Contexts of whole buckets: which of their suffixes start earlier elsewhere, as bits."""
    import numpy as np
    import pyarrow as pa

    t = t.combine_chunks()
    rows = np.asarray(t.column("at").chunk(0).value_lengths(), "int64")
    at_, key, anchor, before = (np.asarray(t.column(c).chunk(0).flatten()) for c in ("at", "key", "anchor", "before"))
    chunk = np.repeat(np.asarray(t.column("chunk")), rows)
    blobs = t.column("context").chunk(0).flatten().to_pylist()
    sizes = np.array([len(x) for x in blobs])
    many = sizes - length + 1
    base = np.cumsum(sizes) - sizes
    rank = np.empty(len(key), "int64")
    rank[np.lexsort((anchor, chunk, key))] = np.arange(len(key))
    _, gram = np.unique(np.array(t.column("gram").chunk(0).flatten().to_pylist(), "S16"), return_inverse=True)
    of = np.repeat(np.arange(len(key)), many)
    step = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
    groups = gram[of] * (length + 1) + (before[of] - step)  # the anchor and how far it is ahead
    positions = base[of] + step
    data = b"".join(blobs)
    gone = np.zeros(len(of), bool)
    may = np.flatnonzero(_hash_repeats(data, positions, groups, length))
    for order, agrees in sort_suffixes(data, positions[may], groups[may], length) if len(may) else ():
        heads = np.flatnonzero(~agrees)
        mine = rank[of[may[order]]]
        low = np.minimum.reduceat(mine, heads)[np.cumsum(~agrees) - 1]
        gone[may[order]] = mine != low
    at = np.concatenate([[0], np.cumsum(many)])
    hit = np.flatnonzero(np.add.reduceat(gone.astype("int64"), at[:-1]) > 0)
    return pa.table({"chunk": pa.array(chunk[hit], pa.int64()), "at": pa.array(at_[hit], pa.int32()),
                     "bits": pa.array([np.packbits(gone[at[j]:at[j + 1]]).tobytes() for j in hit], pa.binary())})


def _send_hot(batches, length):
    """Suffixes of hot anchors, one row each."""
    import numpy as np
    import pyarrow as pa

    for b in batches:
        for i in range(b.num_rows):
            a, first, many, code = _facts(b, i)
            data, offsets = b.column("data")[i].as_py(), np.asarray(b.column("offsets").slice(i, 1).flatten())
            keys = [-2**63 if x is None else x for x in b.column("keys").slice(i, 1).flatten().to_pylist()]
            at = np.flatnonzero(code == HOT)
            pos = [p for s, n in zip(first[at].tolist(), many[at].tolist()) for p in range(s, s + n)]
            for s in range(0, len(pos), 10_000):
                some = pos[s:s + 10_000]
                doc = (np.searchsorted(offsets, some, side="right") - 1).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[d] for d in doc], pa.int64()), pa.array([b.column("chunk")[i].as_py()] * len(some), pa.int64()),
                     pa.array(some, pa.int64()), pa.array([data[p:p + length] for p in some], pa.binary())],
                    names=["key", "chunk", "pos", "suffix"])


def _gone(b, i, length):
    """Bytes of a chunk that are removed, as a mask."""
    import numpy as np

    size = int(b.column("offsets").slice(i, 1).flatten()[-1].as_py())
    a, first, many, code = _facts(b, i)
    starts = np.zeros(size + 1, "int32")
    out = np.isin(code, (LOSES, HOT))
    np.add.at(starts, first[out], 1)
    np.add.at(starts, first[out] + many[out], -1)
    gone = np.cumsum(starts)[:size] > 0
    for x in b.column("bits")[i].as_py() or []:
        s, n = first[x["at"]], many[x["at"]]
        gone[s:s + n] = np.unpackbits(np.frombuffer(x["bits"], "u1"), count=n) != 0
    if "firsts" in b.schema.names:
        gone[[x["pos"] for x in b.column("firsts")[i].as_py() or []]] = False
    upto = np.concatenate([[0], np.cumsum(gone)])  # a byte goes if one of ``length`` suffixes up to it does
    return upto[1:] > upto[np.maximum(np.arange(1, size + 1) - length, 0)]


def _finish(docs: DataFrame, key: str, text: str, make, schema: str, store, length: int = 100, k: int = 20,
            chunk_bytes: int = 4 << 20, bucket_anchors: int = 1 << 20, bucket_bytes: int = 1 << 20,
            hot: int = 50_000) -> DataFrame:
    if not 16 <= k <= length - 8:
        raise ValueError("16 <= k <= length - 8")
    spark = docs.sparkSession
    checkpoint_dir(spark)
    rows_per_batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    chunks, name, total = _chunk_table(docs, key, text, chunk_bytes)
    try:
        expected = 2 * total // (length - k + 2)
        bits = min(24, max(4, (expected // bucket_anchors).bit_length()))
        sent = chunks.select("chunk", "offsets", "data").mapInArrow(
            lambda it: _send_anchors(it, length, k, bits), "chunk long, bucket int, sent binary")
        masks = sent.groupBy("bucket").applyInArrow(_count_anchors, "chunk long, bucket int, size int, mask binary")
        repeated = _join(chunks, _by_chunk(masks, "masks"))
        facts = spill_table(repeated.mapInArrow(
            lambda it: _send_contexts(it, length, k, bits),
            "chunk long, anchor binary, first binary, many binary, sent binary, "
            "parts array<struct<bucket:int,size:int,sent:binary>>"), "suffix-facts")
        ranked = pin(facts.select("chunk", F.explode("parts").alias("p")).select("chunk", "p.bucket", "p.sent")
                     .groupBy("bucket").applyInArrow(lambda t: _rank_contexts(hot, t),
                                                     "chunk long, bucket int, codes binary, hot boolean"))
        own = facts.select("chunk", "anchor", "first", "many", "sent").join(
            _by_chunk(ranked.select("chunk", "bucket", "codes"), "codes"), "chunk", "left")
        known = spill_table(own, "suffix-codes")
        coded = _join(chunks, known)
        # contexts of an anchor meet in one bucket; a bucket holds some MB of them
        buckets = max(16, total // (4 * bucket_bytes))
        contested = coded.mapInArrow(lambda it: _send_contested(it, length, buckets), _CONTESTED)
        bits_found = pin(contested.groupBy("bucket").applyInArrow(lambda t: _sort_bucket(length, t),
                                                                  "chunk long, at int, bits binary"))
        coded = _join(coded, _by_chunk(bits_found, "bits"))
        if ranked.where("hot").limit(1).count():
            suffixes = _join(chunks, known).mapInArrow(lambda it: _send_hot(it, length),
                                                       "key long, chunk long, pos long, suffix binary")
            firsts = suffixes.groupBy("suffix").agg(F.min(F.struct("key", "chunk", "pos")).alias("f")).select("f.chunk", "f.pos")
            coded = _join(coded, _by_chunk(pin(firsts), "firsts"))
        return store(coded.mapInArrow(lambda it: make(it, length), schema))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_per_batch)
        with contextlib.suppress(Exception):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _digests(batches, length):
    import hashlib

    import numpy as np
    import pyarrow as pa

    for b in batches:
        for i in range(b.num_rows):
            gone = _gone(b, i, length)
            data = np.frombuffer(b.column("data")[i].as_py(), "u1")
            offsets = b.column("offsets").slice(i, 1).flatten().to_pylist()
            rows = []
            for s, e in zip(offsets, offsets[1:]):
                g = gone[s:e]
                spans = int(g[:1].sum() + (np.diff(g.astype("i1")) == 1).sum())
                rows.append((e - s, int(g.sum()), spans, hashlib.sha256(data[s:e][~g].tobytes()).hexdigest()))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [b.column("keys").slice(i, 1).flatten(), *(pa.array(c, pa.int64()) for c in cols[:3]),
                 pa.array(cols[3], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeat_digests(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    return _finish(docs, key, text, _digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
                   pin, **options)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with the repeated bytes removed from the text, and all other columns as they were.

    A character is removed if all its bytes are, so the text stays valid UTF-8.
    A null text stays null.
    """
    order = docs.columns
    at = order.index(text)

    def make(batches, length):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for i in range(b.num_rows):
                gone = _gone(b, i, length)
                data = np.frombuffer(b.column("data")[i].as_py(), "u1")
                if len(data):  # a character goes if all its bytes go
                    head = np.flatnonzero((data & 0xC0) != 0x80)
                    gone = np.repeat(np.logical_and.reduceat(gone, head), np.diff([*head, len(data)]))
                offsets = b.column("offsets").slice(i, 1).flatten().to_pylist()
                texts = [data[s:e][~gone[s:e]].tobytes() for s, e in zip(offsets, offsets[1:])]
                with pa.ipc.open_stream(b.column("rest")[i].as_py()) as reader:
                    rest = reader.read_all().combine_chunks()
                was_null = rest.column(rest.num_columns - 1).to_pylist()
                cols = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in rest.columns[:-1]]
                cols.insert(at, pa.array([None if z else x.decode() for x, z in zip(texts, was_null)], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=order)

    schema = docs.schema
    marked = docs.withColumn("__null", F.col(f"`{text}`").isNull())
    return _finish(marked, key, text, make, schema, lambda df: spill_table(df, "suffix-kept"), **options)
