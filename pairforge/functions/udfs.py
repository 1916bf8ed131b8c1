"""The one piece of Python on the way of a row: BPE-encoding its distinct words.

Spark pre-tokenizes; Arrow batches arrive as arrays of words, distinct words are
encoded once per slice of a batch and put back by position.  The helper turns the
words' bytes into ids by repeatedly merging a word's lowest-ranked adjacent pair
(equivalent to replaying the merge list in rank order, since a merge that
uses token t always ranks after the merge that made t).
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bpe_ids(ids: list[int], table: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merge ``ids`` with ``table[(left, right)] = (rank, new_id)``."""
    while len(ids) > 1:
        best = None
        for i in range(len(ids) - 1):
            hit = table.get((ids[i], ids[i + 1]))
            if hit is not None and (best is None or hit[0] < best[0]):
                best = hit
                pair = (ids[i], ids[i + 1])
        if best is None:
            break
        out, i, n = [], 0, len(ids)
        while i < n:
            if i < n - 1 and ids[i] == pair[0] and ids[i + 1] == pair[1]:
                out.append(best[1])
                i += 2
            else:
                out.append(ids[i])
                i += 1
        ids = out
    return ids


def bpe_ids_long(ids: list[int], table: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """``bpe_ids`` for long words: a heap of (rank, position) over a linked list, O(n log n)."""
    import heapq

    n = len(ids)
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    heap = [(*table[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in table]
    heap = [(rank, i, a, b, new) for rank, new, i, a, b in heap]
    heapq.heapify(heap)
    while heap:
        _, i, a, b, new = heapq.heappop(heap)
        j = right[i]
        if ids[i] != a or j < 0 or ids[j] != b:
            continue  # one side has been merged meanwhile
        ids[i], ids[j] = new, -1
        right[i] = right[j]
        if right[i] >= 0:
            left[right[i]] = i
        for at in (left[i], i):
            to = right[at] if at >= 0 else -1
            if to >= 0 and (ids[at], ids[to]) in table:
                rank, made = table[ids[at], ids[to]]
                heapq.heappush(heap, (rank, at, ids[at], ids[to], made))
    return [x for x in ids if x >= 0]


def word_ids(word: str, table, byte_ids=None, unk_id: int | None = None) -> list[int]:
    """Ids of one pre-token; a byte outside the alphabet is ``unk_id``, or an error without one."""
    raw = list(word.encode("utf-8"))
    if byte_ids is not None:
        raw = [byte_ids.get(b, unk_id) for b in raw]
        if None in raw:
            raise ValueError("a byte is outside the model's alphabet and the model has no unknown token")
    return bpe_ids(raw, table) if len(raw) <= 64 else bpe_ids_long(raw, table)


def make_encode_udf(broadcast_table, byte_ids_broadcast=None, unk_id: int | None = None):
    """Arrow UDF word STRING -> ARRAY<INT>; the merge table is a broadcast variable."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def encode_word(words: pd.Series) -> pd.Series:
        table = broadcast_table.value
        byte_ids = byte_ids_broadcast.value if byte_ids_broadcast is not None else None
        return pd.Series([word_ids(w, table, byte_ids, unk_id) for w in words])

    return encode_word


SHORT_WORD = 64           # bytes; longer words go one by one through the heap
SLICE_ITEMS = 1 << 19     # words and specials that are worked on at a time


def _rank_table(table, byte_ids):
    """Sorted pair keys with their ranks and new ids, the key's base, and the id of each byte (-1: none)."""
    import numpy as np

    of_byte = np.arange(256) if byte_ids is None else np.array([byte_ids.get(b, -1) for b in range(256)])
    base = 1 + max([256, int(of_byte.max()), *(max(a, b, n) for (a, b), (_, n) in table.items())])
    rows = sorted((a * base + b, rank, n) for (a, b), (rank, n) in table.items())
    keys, ranks, made = (np.array([r[i] for r in rows], "int64") for i in range(3))
    return keys, ranks, made, base, of_byte


def ids_of_words(words: pa.Array, table, byte_ids=None, unk_id: int | None = None, ranks=None):
    """(ids one after another, ids per word) of an array of words: ``word_ids`` of all of them at once.

    Every round merges in each word all places of its lowest-ranked pair, left to right; a word
    without a pair to merge leaves the rounds.  A round costs the words still in it.
    """
    import numpy as np

    none = np.iinfo("int64").max
    keys, rank_of, made, base, of_byte = ranks or _rank_table(table, byte_ids)
    raw = words.cast(pa.large_binary())
    ends = np.frombuffer(raw.buffers()[1], "int64")[raw.offset:raw.offset + len(raw) + 1]
    if not len(raw) or ends[-1] == ends[0]:
        return np.zeros(0, "int32"), np.zeros(len(raw), "int64")
    flat = of_byte[np.frombuffer(raw.buffers()[2], "uint8")[ends[0]:ends[-1]]].astype("int32")
    if (flat < 0).any():
        if unk_id is None:
            raise ValueError("a byte is outside the model's alphabet and the model has no unknown token")
        flat[flat < 0] = unk_id
    starts = ends[:-1] - ends[0]
    sizes = np.diff(ends)
    out_sizes = sizes.copy()
    for w in np.flatnonzero(sizes > SHORT_WORD):
        at = starts[w]
        got = bpe_ids_long(flat[at:at + sizes[w]].tolist(), table)
        flat[at:at + len(got)], out_sizes[w] = got, len(got)
    active = np.flatnonzero((sizes > 1) & (sizes <= SHORT_WORD)) if len(keys) else np.zeros(0, "int64")
    cur = flat[np.repeat(starts[active], sizes[active]) + _within(sizes[active])]
    while len(active):
        n = out_sizes[active]
        first = np.cumsum(n) - n
        pair = cur[:-1].astype("int64") * base + cur[1:]
        at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        rank = np.full(len(cur), none)
        rank[:-1] = np.where(keys[at] == pair, rank_of[at], none)
        rank[first + n - 1] = none                   # a word's last token begins no pair
        best = np.minimum.reduceat(rank, first)
        going = best != none
        hit = np.flatnonzero((rank == np.repeat(best, n)) & np.repeat(going, n))
        # neighbouring places of one pair (aaa) overlap: every second one of a run is merged
        new_run = np.ones(len(hit), bool)
        new_run[1:] = hit[1:] != hit[:-1] + 1
        run = np.flatnonzero(new_run)
        hit = hit[(np.arange(len(hit)) - np.repeat(run, np.diff(np.append(run, len(hit))))) % 2 == 0]
        cur[hit] = made[at[hit]]
        kept = np.ones(len(cur), bool)
        kept[hit + 1] = False
        n = np.add.reduceat(kept, first, dtype="int64")
        cur = cur[kept]
        done = ~going
        flat[np.repeat(starts[active[done]], n[done]) + _within(n[done])] = cur[np.repeat(done, n)]
        out_sizes[active] = n
        cur = cur[np.repeat(going, n)]
        active = active[going]
    return flat[np.repeat(starts, out_sizes) + _within(out_sizes)], out_sizes


def _within(sizes):
    """0, 1, ... in each run of the given sizes."""
    import numpy as np

    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def packed_type(vocab) -> str:
    """The narrowest type that packed ids of a vocabulary fit."""
    return "<u2" if max(vocab, default=0) < 1 << 16 else "<i4"


def make_unpack_udf(packed: str):
    """Arrow UDF packed ids BINARY -> ARRAY<INT>."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def unpack_ids(raw: pa.Array) -> pa.Array:
        import numpy as np

        raw = raw.cast(pa.large_binary())
        width = np.dtype(packed).itemsize
        ends = np.frombuffer(raw.buffers()[1], "int64")[raw.offset:raw.offset + len(raw) + 1] if len(raw) else np.zeros(1, "int64")
        held = raw.buffers()[2] if ends[-1] > ends[0] else b""
        ids = np.frombuffer(held, "uint8")[ends[0]:ends[-1]].view(packed).astype("int32") if held else np.zeros(0, "int32")
        return pa.ListArray.from_arrays(pa.array(((ends - ends[0]) // width).astype("int32")), pa.array(ids))

    # evaluated once: a filter on the ids must not be pushed below and run it again
    return unpack_ids.asNondeterministic()


def make_row_udf(broadcast_table, byte_ids_broadcast, unk_id: int | None, special_ids: dict[str, int], counts: bool,
                 packed: str | None = None):
    """Arrow UDF (words by segment, specials between the segments) -> ids of the row, or their number.

    With ``packed`` the ids come one after another as a BINARY of that type, which Spark moves as one value.

    A batch is taken in slices of rows with a bounded number of items, and the distinct words of a slice are
    encoded at once; besides the batch and its ids a worker holds one slice, whatever it has seen before.
    """
    kind = T.IntegerType() if counts else T.BinaryType() if packed else T.ArrayType(T.IntegerType())

    @F.arrow_udf(kind)
    def encode_rows(words: pa.Array, found: pa.Array) -> pa.Array:
        import numpy as np

        table = broadcast_table.value
        byte_ids = byte_ids_broadcast.value if byte_ids_broadcast is not None else None
        ranks = _rank_table(table, byte_ids)

        def encode_slice(words, found):
            """Tokens of each row, and with ``counts`` off their ids one after another."""
            segments = words.flatten()                       # every row has one segment more than specials
            flat = segments.flatten().dictionary_encode()
            pool, sizes = ids_of_words(flat.dictionary, table, byte_ids, unk_id, ranks)
            marks = found.flatten().dictionary_encode()
            own = [special_ids[w] for w in marks.dictionary.to_pylist()]
            pool, sizes = np.append(pool, np.array(own, "int32")), np.append(sizes, np.ones(len(own), "int64"))
            per_row = np.asarray(words.value_lengths(), "int64")
            per_segment = np.asarray(segments.value_lengths(), "int64")
            last = np.zeros(len(per_segment), bool)
            last[np.cumsum(per_row) - 1] = True
            # items in order: the words of a segment, then the special that ends it
            items = per_segment + ~last
            is_mark = np.zeros(int(items.sum()), bool)
            is_mark[np.cumsum(items)[~last] - 1] = True
            code = np.empty(len(is_mark), "int32")
            code[is_mark] = np.asarray(marks.indices, "int32") + len(flat.dictionary)
            code[~is_mark] = np.asarray(flat.indices, "int32")
            item_sizes = sizes[code]
            item_ends = np.concatenate([[0], np.cumsum(item_sizes)])
            row_ends = np.cumsum(np.concatenate([[0], items]))[np.concatenate([[0], np.cumsum(per_row)])]
            tokens = np.diff(item_ends[row_ends])
            if counts:
                return tokens, None
            at = np.repeat((np.cumsum(sizes) - sizes)[code] - item_ends[:-1], item_sizes)
            at += np.arange(len(at))
            return tokens, pool[at]

        # words and specials up to each row
        segment_ends = np.concatenate([[0], np.cumsum(np.asarray(words.flatten().value_lengths(), "int64"))])
        per_row = np.concatenate([[0], np.cumsum(np.asarray(words.value_lengths(), "int64"))])
        weight = segment_ends[per_row] + per_row
        done = []
        i = 0
        while i < len(words):
            j = max(i + 1, int(np.searchsorted(weight, weight[i] + SLICE_ITEMS, "right")) - 1)
            done.append(encode_slice(words.slice(i, j - i), found.slice(i, j - i)))
            i = j
        tokens = np.concatenate([d[0] for d in done]) if done else np.zeros(0, "int64")
        if counts:
            return pa.array(tokens.astype("int32"))
        ids = np.concatenate([d[1] for d in done]) if done else np.zeros(0, "int32")
        del done
        if packed:
            raw = ids.astype(packed)
            ends = np.append(0, np.cumsum(tokens)).astype("int64") * raw.itemsize
            return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(tokens), [None, pa.py_buffer(ends), pa.py_buffer(raw)]).cast(pa.binary())
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(tokens)).astype("int32")), pa.array(ids))

    # evaluated once: a filter on the result must not be pushed below and run it again
    return encode_rows.asNondeterministic()
