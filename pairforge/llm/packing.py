"""Operator 3, best-fit packing by hierarchical residual packing.

Tokenising cuts each document into pieces of at most ``capacity`` tokens.  Pieces
that fill a sequence are done.  The others are dealt round-robin over partitions of a
bounded number of items and packed there, largest first, each into the open bin with the
least room that still holds it.  Bins with at most ``tolerance`` tokens of room
left are emitted.  All underfull bins are items of the next round, which deals them anew
over partitions of bounded size and packs them by best fit again, until one partition is
left or as many rounds as a tree of ``fan_in`` branches has levels are over; what is
underfull then is emitted as it is.

After a best-fit round at most one bin of a partition is half empty or less full, so a
further round can only put the few small ones into others: rounds beyond the tree's depth
would deal bins that fit nowhere.  A task reads about ``items_per_task`` pieces at any input
size, and no row is dropped.

Edge cases: the tokenizer's added tokens (its special token among them) are one id where
their string is in a text, as by the library's default; a null or empty text is one piece that holds only the end id; rows
that repeat are packed as often as they come; ties in length go by key, piece and
checksum; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.functions.patterns import PRETOKEN_PATTERN, byte_alphabet
from pairforge.llm.chunks import ChunkTable, split_before_blanks
from pairforge.llm.common import pin, text_batches, worker_cache

#: Pre-tokens always end between a letter or digit and one of these, and after them before a letter or digit.
_WORD_END = re.compile(r"(?<=[^\W_])(?=[.,\n])|(?<=[.,]\n)(?=[^\W_])")

#: The rank encoder's pattern backtracks over a run of white space; texts with runs this long go another way.
_LONG_BLANK = re.compile(r"\s{1000}")

PIECE = "piece int, start long, length long, ids_crc32 long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def rank_encoding(path: str):
    """The tokenizer file's vocabulary as an encoder that merges by rank of the merged bytes, or None.

    Such an encoder joins any two neighbours whose bytes are a token, the tokenizer only
    those in its merge list.  They agree if ids ascend along that list and each token's own text
    is one token: were a neighbouring pair joined that is not listed, the text of both alone would come
    to the same two parts and stay two.  Files that do not show this, or that do more to a text
    than the usual byte-level pre-tokenizer, give None.
    """
    import json

    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    usual = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    if model.get("type") != "BPE" or not usual or spec.get("normalizer") is not None or any(model.get(k) for k in odd):
        return None
    added = {t["content"] for t in spec.get("added_tokens", [])}
    vocab = {t: i for t, i in model["vocab"].items() if t not in added}
    byte_of = {c: b for b, c in byte_alphabet().items()}
    if not byte_of.keys() <= vocab.keys() or not set().union(*vocab) <= byte_of.keys():
        return None
    made = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    if None in made or any(a >= b for a, b in zip(made, made[1:])) or len(made) + len(byte_of) != len(vocab):
        return None
    own = Tokenizer.from_file(path).model
    if any([x.id for x in own.tokenize(t)] != [i] for t, i in vocab.items()):
        return None
    return tiktoken.Encoding("ranks", pat_str=PRETOKEN_PATTERN, special_tokens={},
                             mergeable_ranks={bytes(map(byte_of.__getitem__, t)): i for t, i in vocab.items()})


class Tokens:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    Whole texts go to the rank encoder where the tokenizer file allows one.  Others, and texts
    with very long runs of white space, go by a distinct-chunk table: the tokenizer's
    pre-tokenizer always cuts before a blank that a non-white character follows, so ids of
    the chunks between such cuts concatenate.

    With ``added`` the strings of added tokens are these tokens, as by the library's
    default: texts are cut around them first, and what is between is chunked.
    """

    def __init__(self, path: str, limit: int = 400_000, added: bool = False):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        import numpy as np
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # of chunks, which hold none or hold them as ordinary text
        tokens = self.tokenizer.get_added_tokens_decoder() if added else {}
        self.added = {t.content: np.array([i], "<u4").tobytes() for i, t in tokens.items()}
        # at one place the longest goes first
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if tokens else None
        # tokens that take white space with them, need word ends or see other text: left to the library
        self.whole = Tokenizer.from_file(path) if self.tokenizer.normalizer is not None or any(
            t.lstrip or t.rstrip or t.single_word for t in tokens.values()) else None
        vocab = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocab.values()) + 1, "int64")  # bytes of each id: a token's characters are bytes
        self.sizes[list(vocab.values())] = [len(t) for t in vocab]
        self.table = ChunkTable(self._segment, limit)
        self.ranks = rank_encoding(path)

    def _segment(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks that are not in the table: of their words, each looked up there first."""
        words = [_WORD_END.split(c) for c in chunks]
        table, own = self.table, {}
        for w in set().union(*words):
            own[w] = table.young.get(w) or table.old.get(w)
        missing = [w for w, v in own.items() if v is None]
        own.update(self._encode(missing))
        table.young.update((w, own[w]) for w in missing if len(w) <= table.max_chars)
        return [b"".join(map(own.__getitem__, w)) for w in words]

    def _encode(self, words: list[str]) -> dict[str, bytes]:
        """Ids by the library.  Words that start with one blank are joined for it (a text's pre-token
        always ends there) and told apart again by the bytes that their ids stand for."""
        import numpy as np

        joined = [w for w in words if w[:1] == " " and not w[1:2].isspace() and len(w) > 1]
        lone = [w for w in words if not (w[:1] == " " and not w[1:2].isspace() and len(w) > 1)]
        found = self.tokenizer.encode_batch_fast(lone, add_special_tokens=False)
        out = {w: np.array(e.ids, "<u4").tobytes() for w, e in zip(lone, found)}
        if joined:
            texts = ["".join(joined[i:i + 256]) for i in range(0, len(joined), 256)]
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, "<u4") for e in found])
            ends = np.cumsum(self.sizes[ids])
            word_ends = np.cumsum([len(w.encode()) for w in joined])
            at = np.searchsorted(ends, word_ends)
            if not np.array_equal(ends[at], word_ends):
                raise AssertionError("a pre-token crosses a blank; the chunk table does not fit this tokenizer")
            raw, cuts = ids.tobytes(), [0, *(4 * (at + 1)).tolist()]
            out.update((w, raw[s:e]) for w, s, e in zip(joined, cuts, cuts[1:]))
        return out

    def ids(self, texts: list[str | None]) -> list[bytes]:
        held = [i for i, t in enumerate(texts) if t and self.cut.search(t)] if self.cut else []
        if not held:
            return self._plain(texts)
        marked = set(held)
        out = self._plain([None if i in marked else t for i, t in enumerate(texts)])
        if self.whole is not None:
            import numpy as np

            found = self.whole.encode_batch_fast([texts[i] for i in held], add_special_tokens=False)
            for i, e in zip(held, found):
                out[i] = np.array(e.ids, "<u4").tobytes()
            return out
        parts = [self.cut.split(texts[i]) for i in held]  # text, token, text, ...
        between = iter(self._plain([t for p in parts for t in p[::2]]))
        for i, p in zip(held, parts):
            out[i] = b"".join(self.added[t] if j % 2 else next(between) for j, t in enumerate(p))
        return out

    def _plain(self, texts: list[str | None]) -> list[bytes]:
        """Ids of texts without added tokens."""
        import numpy as np

        out = [b""] * len(texts)
        rest = [i for i, t in enumerate(texts) if t and (self.ranks is None or _LONG_BLANK.search(t))]
        chunked = self.table.look_up([split_before_blanks(texts[i]) for i in rest]) if rest else []
        for i, v in zip(rest, chunked):
            out[i] = b"".join(v)
        left = set(rest)
        for i, t in enumerate(texts):
            if t and i not in left:
                out[i] = np.array(self.ranks.encode_ordinary(t), "<u4").tobytes()
        return out


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = 2048,
           end_id: int = 0, tokenizer_path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32 and, on request, the ids.

    Only documents over ``capacity`` tokens (end id included) are cut; all pieces
    but the first are full.
    """
    path = tokenizer_path or default_tokenizer()
    text_batches(docs.sparkSession)
    key_type = docs.schema[key].dataType.simpleString()

    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        cache = worker_cache()
        tokens = cache.get(("tokens", path)) or cache.setdefault(("tokens", path), Tokens(path, added=True))
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            at, rows, held = [], [], []
            for i, ids in enumerate(tokens.ids(b.column(1).to_pylist())):
                ids += end
                n = len(ids) // 4
                cuts = [0, *range(n - (n - 1) // capacity * capacity, n + 1, capacity)]
                for j, (s, e) in enumerate(zip(cuts, cuts[1:])):
                    at.append(i)
                    part = ids[4 * s:4 * e]
                    rows.append((j, s, e - s, zlib.crc32(part)))
                    if with_ids:
                        held.append(np.frombuffer(part, "<u4").astype("int32"))
            cols = list(zip(*rows)) or [(), (), (), ()]
            out = [b.column(0).take(pa.array(at, pa.int64())), pa.array(cols[0], pa.int32()),
                   *(pa.array(c, pa.int64()) for c in cols[1:])]
            names = [key, "piece", "start", "length", "ids_crc32"]
            if with_ids:
                out.append(pa.array(held, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names=names)

    schema = f"`{key}` {key_type}, {PIECE}" + ", ids array<int>" * with_ids
    return docs.select(key, text).mapInArrow(run, schema)


def best_fit(lengths: list[int], capacity: int) -> list[int]:
    """Bin of each item; items come largest first.  Bins with equal room are interchangeable.

    Open rooms are one bit set, so the least room that fits is its lowest bit
    at or above the item's length.
    """
    rooms, stacks, out, n = 0, {}, [], 0
    for size in lengths:
        fit = rooms >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            stack = stacks[room]
            at = stack.pop()
            if not stack:
                rooms &= ~(1 << room)
        else:
            room, at = capacity, n
            n += 1
        out.append(at)
        room -= size
        if room:
            stacks.setdefault(room, []).append(at)
            rooms |= 1 << room
    return out


def sequence_base(level: int, partition: int) -> int:
    """First id of the bins of one task: 5 bits of level, 31 of partition and 27 of bins never clash."""
    return level << 58 | partition << 27


def pack(items: DataFrame, key: str = "doc_id", capacity: int = 2048, tolerance: int = 16,
         items_per_task: int = 50_000, fan_in: int = 8) -> DataFrame:
    """``items`` as from ``pieces`` -> the same rows with sequence_id and offset.

    ``items`` is read twice, so pass a materialised table.
    """
    spark = items.sparkSession
    kind = items.schema[key].dataType.simpleString()
    member = f"struct<k:{kind},{', '.join(p.replace(' ', ':') for p in PIECE.split(', '))}>"
    schema = f"bin long, level long, final boolean, members array<{member}>"
    full = items.where(F.col("length") >= capacity)
    rest = items.where(F.col("length") < capacity)
    n = rest.count()
    parts = max(1, -(-n // items_per_task))
    rounds = 1
    while fan_in ** (rounds - 1) < parts:
        rounds += 1
    packed_member = F.struct(F.col(key).alias("k"), "piece", "start", "length", "ids_crc32")
    bins = rest.select(F.lit(0).cast("long").alias("bin"), F.col("length").alias("level"), F.lit(False).alias("final"),
                       F.array(packed_member).alias("members"))
    done, level = [], 0
    while n:
        level += 1
        last = parts == 1 or level == rounds

        def merge(batches, last=last, level=level):
            import pyarrow as pa
            from pyspark import TaskContext

            rows = [r for b in batches for r in zip(b.column("level").to_pylist(), b.column("members").to_pylist())]
            if not rows:
                return
            order = lambda m: (-(m["k"] is None), m["k"] if m["k"] is not None else 0, m["piece"], m["ids_crc32"])
            rows.sort(key=lambda r: (-r[0], order(r[1][0])))
            made: dict[int, list] = {}
            for at, r in zip(best_fit([r[0] for r in rows], capacity), rows):
                made.setdefault(at, []).extend(r[1])
            first = sequence_base(level, TaskContext.get().partitionId())
            levels = {at: sum(m["length"] for m in ms) for at, ms in made.items()}
            kept = set() if last else {at for at in made if levels[at] < capacity - tolerance}
            at = list(made)
            for i in range(0, len(at), 4096):
                part = at[i:i + 4096]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([first + a for a in part], pa.int64()), pa.array([levels[a] for a in part], pa.int64()),
                     pa.array([a not in kept for a in part], pa.bool_()),
                     pa.array([made[a] for a in part], member_type)],
                    names=["bin", "level", "final", "members"])

        member_type = _arrow(spark, f"members array<{member}>")
        # round-robin: equal rows spread, and no key decides
        bins = pin(bins.repartition(parts).mapInArrow(merge, schema))
        done.append(bins.where("final"))
        if last:
            break
        bins = bins.where(~F.col("final"))
        parts = max(1, -(-(bins.agg(F.sum(F.size("members"))).first()[0] or 0) // items_per_task))
    # full pieces count down from -1, bins are positive
    out = full.select(key, "piece", "start", "length", "ids_crc32",
                      (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    for b in done:
        # members in order; the offset is the sum of the lengths before
        placed = b.select("bin", F.posexplode("members").alias("__at", "m"),
                          F.col("members.length").alias("__all"))
        out = out.union(placed.select(
            F.col("m.k").alias(key), "m.piece", "m.start", "m.length", "m.ids_crc32", F.col("bin").alias("sequence_id"),
            F.aggregate(F.slice("__all", 1, F.col("__at")), F.lit(0).cast("long"), lambda a, x: a + x).alias("offset")))
    return out


def _arrow(spark, ddl: str):
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    return to_arrow_type(StructType.fromDDL(ddl)[0].dataType)


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = 2048,
                   tokenizer_path: str | None = None, **options) -> DataFrame:
    """Tokenise, cut and pack whole documents; see the module docstring."""
    return pack(pin(pieces(docs, key, text, capacity, tokenizer_path=tokenizer_path)), key, capacity, **options)
