"""BPE training as distributed DataFrame rounds (M4-M8, F1).

Each round fetches the best pairs with their exact counts, accepts the longest prefix that
one-at-a-time training would also have chosen, and applies it to the compacted words:

* the first candidate is always the true best pair;
* a later candidate q = (c, d) with count m is accepted only if
  (1) its occurrences cannot overlap an accepted p = (a, b): d != a and c != b,
      so merging p leaves count(q) unchanged, and
  (2) no pair with count >= m (ties included) has right == a or left == b for an
      accepted p: every pair created by merging p is bounded by such a pair, so
      none can reach m and outrank q;  pairs not touching p only lose counts.
* a candidate that ties with the bound of the unseen pairs ends the round.

Where counts come from is ``TrainConfig.count_mode``.  ``recount`` explodes the pairs of all words in
every round, aggregates them partially and finally, and takes the top K; the word table is persisted
each round and reliably checkpointed (to ``spark.checkpoint.dir``) every few rounds to cut lineage.  The
other modes (``pairforge.plans.incremental``) keep the best counts on the driver and touch what changes.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.functions.expressions import char_to_id, id_to_char, pair_left_id, pair_right_id
from pairforge.functions.patterns import DEFAULT_SPECIAL_TOKEN, byte_alphabet
from pairforge.operators.merges import Merge, merge_expr
from pairforge.operators.pairs import pair_counts, top_pairs
from pairforge.operators.pretokenize import training_words, word_counts
from pairforge.operators.vocab import initial_vocab, vocab_frame
from pairforge.session import checkpoint_dir, scratch_path


@dataclass
class TrainConfig:
    vocab_size: int
    special_tokens: Sequence[str] = (DEFAULT_SPECIAL_TOKEN,)
    specials_first: bool = False      # P6b: specials at id 0.., bytes after them
    batch_merges: bool = True         # False: one merge per round (test oracle)
    candidates: int = 1024            # K rows fetched per round
    speculate: int = 0                # >1: recount, and try this many merges per round, verified exactly
    count_mode: str = "frontier"      # "frontier" (O2) | "delta" (M3) | "index" (Jn2) | "recount"
    checkpoint_every: int = 10
    buckets: int | None = None        # delta, index: buckets of the logged tables
    fold_every: int = 8               # delta, index: rounds between folds
    initial_alphabet: str = "all"     # "all" | "observed" (M8)
    unk_token: str | None = None      # M8: extra special for unknown bytes
    word_partitions: int | None = None


@dataclass
class RoundStat:
    round: int
    merges: int
    seconds: float
    top_count: int
    recount: bool = True              # were the pairs counted anew?


@dataclass
class BpeModel:
    vocab: dict[int, bytes]
    kinds: dict[int, str]
    merges: list[Merge]
    special_tokens: tuple[str, ...] = ()
    rounds: list[RoundStat] = field(default_factory=list)
    unk_token: str | None = None

    def merges_bytes(self) -> list[tuple[bytes, bytes]]:
        return [(self.vocab[a], self.vocab[b]) for a, b, _ in self.merges]

    def special_ids(self) -> dict[str, int]:
        out = {}
        for i, k in sorted(self.kinds.items()):
            if k == "special":
                out.setdefault(self.vocab[i].decode("utf-8"), i)
        return out

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        return vocab_frame(spark, self.vocab, self.kinds)

    def merges_df(self, spark: SparkSession) -> DataFrame:
        rows = [(r, a, b, n, bytearray(self.vocab[a]), bytearray(self.vocab[b]))
                for r, (a, b, n) in enumerate(self.merges)]
        return spark.createDataFrame(
            rows, "rank INT, left_id INT, right_id INT, new_id INT, left_bytes BINARY, right_bytes BINARY")

    def relabel_specials_first(self, byte_order: str = "alphabet") -> BpeModel:
        """Same model with specials at ids 0.. and the bytes after them.

        ``byte_order='alphabet'`` numbers bytes by their printable-alphabet
        character (the layout of published vocab files); ``'byte'`` by value.
        """
        specials = [i for i in sorted(self.kinds) if self.kinds[i] == "special"]
        byte_ids = [i for i in sorted(self.kinds) if self.kinds[i] == "byte"]
        if byte_order == "alphabet":
            alpha = byte_alphabet()
            byte_ids.sort(key=lambda i: ord(alpha[self.vocab[i][0]]))
        order = specials + byte_ids
        remap = {old: new for new, old in enumerate(order)}
        vocab = {remap.get(i, i): b for i, b in self.vocab.items()}
        kinds = {remap.get(i, i): k for i, k in self.kinds.items()}
        merges = [(remap.get(a, a), remap.get(b, b), remap.get(n, n)) for a, b, n in self.merges]
        return BpeModel(vocab, kinds, merges, self.special_tokens, self.rounds, self.unk_token)


def rank_candidates(rows: Sequence[tuple[int, int, int]], vocab: dict[int, bytes]
                    ) -> list[tuple[int, int, int]]:
    """Order (left, right, n) by count desc, bytes desc, bytes desc, ids asc."""
    out = sorted(rows, key=lambda t: (t[0], t[1]))
    out.sort(key=lambda t: (t[2], vocab[t[0]], vocab[t[1]]), reverse=True)  # stable
    return out


def accept_batch(cands: Sequence[tuple[int, int, int]], truncated: bool, budget: int,
                 batch: bool = True) -> list[tuple[int, int, int]]:
    """Longest prefix of ranked candidates equal to one-at-a-time training."""
    if not cands or budget <= 0:
        return []
    out = [cands[0]]
    if not batch:
        return out
    last_n = cands[-1][2]
    lefts, rights = {cands[0][0]}, {cands[0][1]}
    for j in range(1, len(cands)):
        if len(out) >= budget:
            break
        left, right, m = cands[j]
        if truncated and m == last_n:
            break  # ties with unseen pairs
        if right in lefts or left in rights:
            break  # overlaps an accepted merge: its count may change
        blocked = False
        for tl, tr, tn in cands:  # all pairs with count >= m are fetched here
            if tn < m:
                break
            if tr in lefts or tl in rights:
                blocked = True
                break
        if blocked:
            break
        out.append(cands[j])
        lefts.add(left)
        rights.add(right)
    return out


def verify_speculation(cands: Sequence[tuple[int, int, int]], truncated: bool,
                       steps: Sequence[Merge], deltas: dict[int, list[tuple[tuple[int, int], int]]],
                       vocab: dict[int, bytes], budget: int, allow_extra: bool) -> list[tuple[int, int]]:
    """Replay speculated merges with their exact count changes; keep the true prefix.

    ``cands`` are exact current counts of the top pairs (ranked); every pair not
    among them counts at most the last fetched count when ``truncated``.
    ``steps`` were applied in order to produce ``deltas[step]``.  A step is
    accepted only while it is provably the best pair: it beats every known
    count (top pairs and pairs made of this round's new tokens, whose earlier
    count is exactly 0) and, if unseen pairs exist, exceeds their bound.  At the
    first divergence the proven best pair is also accepted when ``allow_extra``.
    """
    known = {(a, b): n for a, b, n in cands}
    floor = cands[-1][2] if truncated and cands else None
    first_new = steps[0][2] if steps else None
    v = dict(vocab)
    for a, b, n in steps:
        v[n] = v[a] + v[b]

    def key(item):
        (a, b), n = item
        return (n, v[a], v[b], -a, -b)

    out: list[tuple[int, int]] = []
    for j, (a, b, _) in enumerate(steps):
        if len(out) >= budget or not known:
            break
        best, n = max(known.items(), key=key)
        if floor is not None and n <= floor:
            break  # unseen pairs may tie or win
        if best != (a, b):
            if allow_extra:
                out.append(best)
            break
        out.append(best)
        for pair, d in deltas.get(j + 1, ()):
            if pair in known or pair[0] >= first_new or pair[1] >= first_new:
                c = known.get(pair, 0) + d
                if c > 0:
                    known[pair] = c
                else:
                    known.pop(pair, None)
    return out


class _Cache:
    """Round-to-round tables: persisted, reliably checkpointed every few rounds."""

    def __init__(self, every: int):
        self.every = max(1, every)
        self.old: list[DataFrame] = []

    def keep(self, df: DataFrame, round_no: int) -> DataFrame:
        if round_no % self.every == 0:
            return df.checkpoint(eager=True)
        return df.persist(StorageLevel.MEMORY_AND_DISK)

    def retire(self, df: DataFrame | None) -> None:
        if df is not None:
            self.old.append(df)

    def release(self) -> None:
        """Drop retired tables."""
        for df in self.old:
            df.unpersist()
        self.old = []


def _next_free(vocab: dict[int, bytes], start: int) -> int:
    i = start
    while i in vocab:
        i += 1
    return i


def train_words(spark: SparkSession, words: DataFrame, cfg: TrainConfig,
                vocab: dict[int, bytes] | None = None, kinds: dict[int, str] | None = None
                ) -> BpeModel:
    """Train on a word table ``seq, n`` (M7 / F1).

    ``seq`` is a token string (code point = token id); ``vocab`` must map every
    id that occurs in it.  Defaults to bytes + ``cfg.special_tokens``.

    The rounds run with adaptive execution off: each round is a small job whose
    only shuffle carries pre-aggregated pair counts (no skew to split, nothing
    worth coalescing), and AQE's per-stage re-planning costs more than it saves
    (measured 36 s vs 41-57 s of round time at sf0.1).  That holds in a session of
    the training's own; queries and streams of the caller's session keep theirs.
    The word table is written once below the checkpoint folder for it.
    """
    path = scratch_path(spark, "train-words")
    words.select("seq", F.col("n").cast("bigint").alias("n")).write.parquet(path)
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.adaptive.enabled", "false")
    own.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # index lookups stay bucket by bucket
    return _train_words(own, own.read.schema("seq STRING, n BIGINT").parquet(path), cfg, vocab, kinds)


def _train_words(spark: SparkSession, words: DataFrame, cfg: TrainConfig,
                 vocab: dict[int, bytes] | None, kinds: dict[int, str] | None) -> BpeModel:
    from pairforge.operators.encode import work_partitions
    from pairforge.operators.merges import step_deltas

    checkpoint_dir(spark)
    specials = list(cfg.special_tokens)
    if cfg.unk_token and cfg.unk_token not in specials:
        specials.append(cfg.unk_token)
    if vocab is None:
        vocab, kinds = initial_vocab(specials)
    vocab = dict(vocab)
    kinds = dict(kinds or {i: "byte" if i < 256 else "special" for i in vocab})
    if cfg.count_mode not in ("recount", "frontier", "delta", "index"):
        raise ValueError(f"unknown count_mode {cfg.count_mode!r}")
    if cfg.count_mode != "recount" and not cfg.speculate:  # speculation needs the recounted words
        return _train_incrementally(spark, words, cfg, vocab, kinds, specials)
    budget = max(0, cfg.vocab_size - len(vocab))
    next_id = _next_free(vocab, 256)
    merges: list[Merge] = []
    stats: list[RoundStat] = []
    spec = max(0, cfg.speculate)
    k = max(2, cfg.candidates)
    cache = _Cache(cfg.checkpoint_every)

    # spread the compact word table over every core: AQE would leave it in the
    # one or two partitions its byte size suggests, but each round is CPU-bound
    cur = (words.select("seq", F.col("n").cast("bigint").alias("n")).where(F.length("seq") >= 2)
           .repartition(cfg.word_partitions or work_partitions(spark)))
    cur = cache.keep(cur, 1)
    round_no = 0
    while len(merges) < budget:
        t0 = time.time()
        left = budget - len(merges)
        horizon = max(vocab) + max(spec, k, left) + 1  # largest id that may appear this round
        pc = pair_counts(cur, max_id=horizon)
        rows = pc.orderBy(F.desc("n")).limit(k).collect()
        cache.release()  # `cur` is materialised now; older tables can go
        if not rows:
            break
        cands = rank_candidates([(char_to_id(r["pair"][0]), char_to_id(r["pair"][1]), int(r["n"]))
                                 for r in rows], vocab)
        truncated = len(rows) == k
        if truncated and cands[0][2] == cands[-1][2]:
            # every fetched row ties: rank that count level by bytes in Spark
            best = top_pairs(pc.where(F.col("n") == cands[0][2]), vocab_frame(spark, vocab, kinds), 1
                             ).select("left", "right", "n").collect()[0]
            cands, truncated = [(int(best["left"]), int(best["right"]), int(best["n"]))], False
        drows = None
        if spec > 1 and len(cands) > 1 and left > 1:
            steps, v, nid = [], dict(vocab), next_id
            for a, b, _ in cands[:min(spec, left)]:
                v[nid] = v[a] + v[b]
                steps.append((a, b, nid))
                nid = _next_free(v, nid + 1)
            d = step_deltas(cur, steps, horizon).persist(StorageLevel.MEMORY_AND_DISK)
            # The check asks for candidates and for pairs with a new token only: at most
            # steps x (candidates + 2 x vocab_size) rows reach the driver.
            asked = (F.col("pair").isin([id_to_char(a) + id_to_char(b) for a, b, _ in cands])
                     | (pair_left_id("pair") >= next_id) | (pair_right_id("pair") >= next_id))
            drows = d.where(asked).collect()
            deltas: dict[int, list] = {}
            for r in drows:
                deltas.setdefault(int(r["step"]), []).append(
                    ((char_to_id(r["pair"][0]), char_to_id(r["pair"][1])), int(r["n"])))
            chosen = verify_speculation(cands, truncated, steps, deltas, vocab, left, allow_extra=True)
            if not chosen:  # the first candidate is always the true best
                chosen = [cands[0][:2]]
        else:
            chosen = [(a, b) for a, b, _ in accept_batch(cands, truncated, left, cfg.batch_merges)]
        new: list[Merge] = []
        for a, b in chosen:
            vocab[next_id] = vocab[a] + vocab[b]
            kinds[next_id] = "merge"
            new.append((a, b, next_id))
            next_id = _next_free(vocab, next_id + 1)
        merges.extend(new)
        if drows is not None:
            cache.retire(d)
        round_no += 1
        stats.append(RoundStat(round_no, len(new), time.time() - t0, cands[0][2]))
        if len(merges) >= budget:
            break
        cache.retire(cur)
        cur = cache.keep(cur.select(merge_expr("seq", new).alias("seq"), "n").where(F.length("seq") >= 2), round_no + 1)
    cache.retire(cur)
    cache.release()
    model = BpeModel(vocab, kinds, merges, tuple(specials), stats, cfg.unk_token)
    return model.relabel_specials_first() if cfg.specials_first else model


def _train_incrementally(spark: SparkSession, words: DataFrame, cfg: TrainConfig, vocab: dict[int, bytes],
                         kinds: dict[int, str], specials: Sequence[str]) -> BpeModel:
    """Rounds that only touch what changed; see ``pairforge.plans.incremental``."""
    from pairforge.operators.encode import work_partitions
    from pairforge.plans.incremental import merge_rounds, open_store

    store = open_store(spark, words, cfg, cfg.word_partitions or work_partitions(spark), max(vocab, default=0))
    merges: list[Merge] = []
    stats: list[RoundStat] = []
    try:
        t0 = time.time()
        for new, top, recount in merge_rounds(store, cfg, vocab, kinds, lambda v, k: vocab_frame(spark, v, k)):
            merges.extend(new)
            stats.append(RoundStat(len(stats) + 1, len(new), time.time() - t0, top, recount))
            t0 = time.time()
    finally:
        store.close()
    model = BpeModel(vocab, kinds, merges, tuple(specials), stats, cfg.unk_token)
    return model.relabel_specials_first() if cfg.specials_first else model


def train(spark: SparkSession, docs: DataFrame, cfg: TrainConfig, text_col: str = "text") -> BpeModel:
    """Train a byte-level BPE model on a document table (M4).

    ``docs`` is split at the special tokens, pre-tokenized and compacted to
    distinct words before the rounds start.  With ``initial_alphabet='observed'``
    (M8) the vocabulary starts from the bytes that occur (at most 256 rows reach
    the driver) instead of all 256, leaving more room for merges; bytes never
    seen are encoded as ``unk_token`` when one is configured.
    """
    wc = word_counts(docs, text_col, cfg.special_tokens)
    if cfg.initial_alphabet != "observed":
        return train_words(spark, training_words(wc), cfg)
    from pairforge.operators.pretokenize import byte_histogram
    wc = wc.persist()
    present = sorted(int(r["byte"]) for r in byte_histogram(wc).select("byte").collect())
    vocab = {b: bytes([b]) for b in present}
    kinds = {b: "byte" for b in present}
    specials = list(cfg.special_tokens) + ([cfg.unk_token] if cfg.unk_token and
                                           cfg.unk_token not in cfg.special_tokens else [])
    nid = 256
    for sp in specials:
        vocab[nid], kinds[nid] = sp.encode("utf-8"), "special"
        nid += 1
    model = train_words(spark, training_words(wc), cfg, vocab, kinds)
    model.special_tokens = tuple(specials)
    wc.unpersist()
    return model
