"""Training that touches only what a merge changes (Jn2, A2, P10, M3, O2).

The driver keeps a *frontier*: the exact counts of the best pairs and a bound that no other
pair exceeds.  Merges only lower the counts of pairs they do not create, and pairs they create
are counted completely in the round that makes them, so the bound stays true until the best
known pair sinks to it; only then are the pairs counted again (O2: far fewer counts than rounds).
A round asks the cluster for the count changes of known pairs that touch a merge and of new pairs
above the bound: a few rows.

Rounds work on *pieces* (``CutWords``).  When the whole words are counted, a floor is set below the best
count; until the best pair sinks to it, no merge can join two tokens whose pair counts no more than the floor.
So the words are cut there and equal pieces are added up: far fewer rows than words, since rare spellings
fall apart into common pieces.  At the floor all merges go into the whole words, which are counted and cut again.

Where pieces and counts live is a store.  All give the same merges:

* ``ScanWords``: cached table, rewritten each round; changes come from the rows that hold a
  merged pair; a recount above the floor counts the table (``count_mode="frontier"``).
* ``ScanWords`` with a ``CountLog``: that recount reads counts and their changes instead
  (``count_mode="delta"``, M3).
* ``WordIndex``: inverted index pair -> rows with a ``CountLog``; rounds read no word
  table (``count_mode="index"``, Jn2).

``CountLog`` and ``WordIndex`` are tables bucketed by pair.  A round appends its signed changes,
dealt by the same hash, so it shuffles and writes changes only; reading sums or picks the latest
rows inside a bucket without an exchange, and a lookup of pairs opens their buckets alone.
Every ``fold_every`` rounds a table is folded into its present state, again bucket by bucket.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.functions.expressions import char_to_id, id_to_char, pairs_expr
from pairforge.operators.merges import Merge
from pairforge.operators.pairs import pair_counts, top_pairs
from pairforge.session import scratch_path


def sql_text(ids: Sequence[int]) -> str:
    """A token string as a SQL literal."""
    return "'" + "".join(f"\\U{ord(id_to_char(i)):08x}" for i in ids) + "'"


# Rounds are short, so their expressions are parsed from one text each: building them call by call took
# as long as the small jobs themselves.

def pair_in(pairs: Sequence[tuple[int, int]]) -> str:
    return f"pair IN ({', '.join(map(sql_text, pairs))})" if pairs else "false"


def merged_sql(seq: str, merges: Sequence[Merge]) -> str:
    """``merge_expr`` as text."""
    for left, right, new in merges:
        seq = f"replace({seq}, {sql_text([left, right])}, {sql_text([new])})"
    return seq


def replayed_sql(seq: str, merges: Sequence[Merge]) -> str:
    """``merge_expr`` for any number of merges: a loop, as deep nests of ``replace`` outgrow parser and compiler."""
    steps = ", ".join(f"struct({sql_text([left, right])} AS pair, {sql_text([new])} AS new)" for left, right, new in merges)
    return f"aggregate(array({steps}), {seq}, (s, m) -> replace(s, m.pair, m.new))"


def holds_sql(seq: str, merges: Sequence[Merge]) -> str:
    """``contains_any`` as text."""
    return " OR ".join(f"contains({seq}, {sql_text(m[:2])})" for m in merges)


class Frontier:
    """Exact counts of the best pairs; every pair that is not here counts at most ``bound``."""

    def __init__(self, size: int):
        self.size = size
        self.bound = 0
        self.known: dict[tuple[int, int], int] = {}

    def load(self, rows: Sequence[tuple[str, int]], floor: int = 0) -> None:
        """The top ``size`` pairs, best first; fewer rows mean that there are no others above ``floor``."""
        self.bound = max(floor, rows[-1][1] if len(rows) == self.size else 0)
        self.known = {(char_to_id(p[0]), char_to_id(p[1])): n for p, n in rows if n > self.bound}

    def lift(self, bound: int) -> None:
        """Forget the pairs that count at most ``bound``."""
        self.bound = max(self.bound, bound)
        self.known = {p: n for p, n in self.known.items() if n > self.bound}

    def touched(self, merges: Sequence[Merge]) -> list[tuple[int, int]]:
        """Known pairs whose count these merges may change: any other pair overlaps none of them."""
        lefts, rights = {m[0] for m in merges}, {m[1] for m in merges}
        return [p for p in self.known if p[1] in lefts or p[0] in rights or p[0] in lefts and p[1] in rights]

    def update(self, changes: Sequence[tuple[tuple[int, int], int]]) -> None:
        for p, d in changes:
            n = self.known.get(p, 0) + d
            if n > self.bound:
                self.known[p] = n
            else:
                self.known.pop(p, None)
        if len(self.known) > 4 * self.size:  # forget the lower half; the bound covers it
            self.lift(sorted(self.known.values(), reverse=True)[2 * self.size])


def _asked(pairs: Sequence[tuple[int, int]], first_new: int, bound: int) -> str:
    """Rows of a change table that the frontier needs: pairs with a new token above the bound, and known ones."""
    code = ord(id_to_char(first_new))
    return f"(ascii(substr(pair, 1, 1)) >= {code} OR ascii(substr(pair, 2, 1)) >= {code}) AND n > {bound} OR {pair_in(pairs)}"


def _rows(df: DataFrame) -> list[tuple[tuple[int, int], int]]:
    return [((char_to_id(r["pair"][0]), char_to_id(r["pair"][1])), int(r["n"])) for r in df.collect()]


def signed_pairs(changed: DataFrame, max_id: int) -> DataFrame:
    """``pair, n``: change of the pair counts by rows ``old, new, n`` of rewritten words."""
    sides = changed.selectExpr("explode(array(struct(old AS seq, -n AS w), struct(new AS seq, n AS w))) AS s").where("length(s.seq) >= 2")
    return (sides.select(F.explode(pairs_expr("s.seq", max_id)).alias("pair"), "s.w").groupBy("pair")
            .agg(F.expr("cast(sum(w) AS bigint) AS n")).where("n != 0"))


class BucketLog:
    """A table bucketed by ``pair`` to which rounds append and which is folded now and then."""

    def __init__(self, spark: SparkSession, name: str, buckets: int, fold_every: int):
        self.spark, self.name, self.buckets, self.fold_every = spark, name, buckets, fold_every
        self.table, self.path, self.appends = None, None, 0

    def _write(self, df: DataFrame, mode: str) -> None:
        # dealt by the hash of the buckets: one file a bucket, and the only exchange of an append
        (df.repartition(self.buckets, "pair").write.mode(mode).format("parquet").bucketBy(self.buckets, "pair")
         .sortBy("pair").option("path", self.path).saveAsTable(self.table))

    def start(self, df: DataFrame) -> None:
        old = self.table
        self.table = f"{self.name}_{uuid.uuid4().hex[:12]}"
        self.path = scratch_path(self.spark, self.name.replace("_", "-"))
        self._write(df, "errorifexists")
        self.appends = 0
        if old:
            self.spark.sql(f"DROP TABLE {old}")

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, df: DataFrame) -> None:
        self._write(df, "append")
        self.appends += 1

    def due(self) -> bool:
        return self.appends >= self.fold_every

    def drop(self) -> None:
        if self.table:
            self.spark.sql(f"DROP TABLE {self.table}")


class CountLog(BucketLog):
    """``pair, n``: counts and their signed changes; the present count is the sum of a pair's rows."""

    def __init__(self, spark: SparkSession, counts: DataFrame, buckets: int, fold_every: int):
        super().__init__(spark, "pair_counts", buckets, fold_every)
        self.start(counts.select("pair", "n"))

    def counts(self) -> DataFrame:
        return self.read().groupBy("pair").agg(F.sum("n").cast("bigint").alias("n")).where(F.col("n") > 0)

    def add(self, changes: DataFrame) -> None:
        if self.due():
            self.start(self.counts())
        self.append(changes.select("pair", "n"))


class ScanWords:
    """Words in a cached table of which every round makes the next; optionally with logged counts."""

    def __init__(self, spark: SparkSession, words: DataFrame, parts: int, max_id: int, checkpoint_every: int,
                 buckets: int = 0, fold_every: int = 8):
        self.spark, self.every, self.round, self.max_id = spark, max(1, checkpoint_every), 0, max_id
        self.cur = self._keep(words.where(F.length("seq") >= 2).repartition(parts))
        self.old: list[DataFrame] = []
        self.log = CountLog(spark, pair_counts(self.cur, max_id=max_id), buckets, fold_every) if buckets else None

    def _keep(self, df: DataFrame) -> DataFrame:
        self.round += 1
        if self.round % self.every == 0:
            return df.checkpoint(eager=True)
        return df.persist(StorageLevel.MEMORY_AND_DISK)

    def counts(self) -> DataFrame:
        return self.log.counts() if self.log else pair_counts(self.cur, max_id=self.max_id)

    def apply(self, merges: Sequence[Merge], pairs, first_new: int, bound: int):
        self.max_id = max(self.max_id, *(m[2] for m in merges))
        merged = merged_sql("seq", merges)
        hit = self.cur.where(holds_sql("seq", merges)).selectExpr("seq AS old", f"{merged} AS new", "n")
        changes = signed_pairs(hit, self.max_id)
        if self.log:
            changes = changes.persist(StorageLevel.MEMORY_AND_DISK)
            self.log.add(changes)
        out = _rows(changes.where(_asked(pairs, first_new, bound)))
        if self.log:
            changes.unpersist()
        # the round's job has materialised `cur`; what it was made from can go
        for df in self.old:
            df.unpersist()
        self.old = [self.cur]
        self.cur = self._keep(self.cur.selectExpr(f"{merged} AS seq", "n").where("length(seq) >= 2"))
        return out

    def close(self) -> None:
        for df in [*self.old, self.cur]:
            df.unpersist()
        if self.log:
            self.log.drop()


class WordIndex(BucketLog):
    """Inverted index ``pair -> words`` with the words' present tokens, and a log of pair counts.

    A row says that since ``version`` word ``word_id`` (``seq``, occurring ``n`` times) holds the
    pair, or with ``live = false`` that it does not any more.  A rewritten word gets a row for
    every pair it had or has, so the latest row of a pair and word is the truth, and a pair's
    bucket answers for it alone.
    """

    COLUMNS = ("pair", "word_id", "seq", "n", "version", "live")

    def __init__(self, spark: SparkSession, words: DataFrame, max_id: int, buckets: int, fold_every: int = 8):
        super().__init__(spark, "word_index", buckets, fold_every)
        path = scratch_path(spark, "index-words")  # written once, so ids stay what they are
        words.where(F.length("seq") >= 2).withColumn("word_id", F.monotonically_increasing_id()).write.parquet(path)
        numbered = spark.read.schema("seq STRING, n BIGINT, word_id BIGINT").parquet(path)
        self.max_id, self.version = max_id, 0
        held = numbered.select(F.explode(F.array_distinct(pairs_expr("seq", max_id))).alias("pair"), "word_id", "seq", "n")
        self.start(held.select("*", F.lit(0).alias("version"), F.lit(True).alias("live")))
        self.log = CountLog(spark, pair_counts(numbered, max_id=max_id), buckets, fold_every)

    def counts(self) -> DataFrame:
        return self.log.counts()

    @staticmethod
    def _latest(rows: DataFrame, *keys: str) -> DataFrame:
        """The newest row of each key; of one version the live one, for a word looked up by several pairs."""
        best = F.max(F.struct("version", "live", "seq", "n")).alias("v")
        return rows.groupBy(*keys).agg(best).where("v.live").select(*keys, "v.seq", "v.n", "v.version", "v.live")

    def lookup(self, merges: Sequence[Merge]) -> DataFrame:
        """``word_id, seq, n`` of the words that hold one of the merged pairs (P10, Jn2); opens their buckets only."""
        rows = self.read().where(pair_in([m[:2] for m in merges]))
        return self._latest(rows, "word_id").select("word_id", "seq", "n")

    def index(self) -> DataFrame:
        """``pair, word_id`` as of now (A2)."""
        return self._latest(self.read(), "pair", "word_id").select("pair", "word_id")

    def apply(self, merges: Sequence[Merge], pairs, first_new: int, bound: int):
        self.max_id = max(self.max_id, *(m[2] for m in merges))
        self.version += 1
        path = scratch_path(self.spark, "index-changed")
        found = self.lookup(merges).selectExpr("word_id", "n", "seq AS old", f"{merged_sql('seq', merges)} AS new")
        found.write.parquet(path)
        hit = self.spark.read.schema("word_id BIGINT, n BIGINT, old STRING, new STRING").parquet(path)
        changes = signed_pairs(hit, self.max_id).persist(StorageLevel.MEMORY_AND_DISK)
        self.log.add(changes)
        out = _rows(changes.where(_asked(pairs, first_new, bound)))
        changes.unpersist()
        had, has = F.array_distinct(pairs_expr("old", self.max_id)), F.array_distinct(pairs_expr("new", self.max_id))
        row = ("word_id", F.col("new").alias("seq"), "n", F.lit(self.version).alias("version"))
        now = hit.select(F.explode(has).alias("pair"), *row, F.lit(True).alias("live"))
        gone = hit.select(F.explode(F.array_except(had, has)).alias("pair"), *row, F.lit(False).alias("live"))
        if self.due():
            self.start(self._latest(self.read(), "pair", "word_id").select(*self.COLUMNS))
        self.append(now.unionByName(gone).where(F.length("pair") == 2).select(*self.COLUMNS))
        return out

    def close(self) -> None:
        self.drop()
        self.log.drop()


#: The floor is the best count over this: at 8 a count and a cut of the whole words serve merges until counts are an eighth.
FLOOR_SHARE = 8


def cut_pieces(words: DataFrame, kept: dict[tuple[int, int], int]) -> DataFrame:
    """Words ``seq, n`` cut between any two tokens whose pair is not ``kept`` (pair: count); equal pieces added up.

    One regular expression takes tokens as long as the next makes a kept pair, the most frequent left
    tokens first.  Its loop is possessive, so long words cannot exhaust the stack.
    """
    rights: dict[int, list[int]] = {}
    weight: dict[int, int] = {}
    for (a, b), n in kept.items():
        rights.setdefault(a, []).append(b)
        weight[a] = weight.get(a, 0) + n

    def code(i):
        return f"\\x{{{ord(id_to_char(i)):x}}}"

    follow = "|".join(f"{code(a)}(?=[{''.join(map(code, sorted(rights[a])))}])" for a in sorted(rights, key=lambda a: (-weight[a], a)))
    pieces = F.regexp_extract_all("seq", F.lit(f"(?s)(?:{follow})*+."), F.lit(0))
    return (words.select(F.explode(pieces).alias("seq"), "n").where(F.length("seq") >= 2).groupBy("seq")
            .agg(F.sum("n").cast("bigint").alias("n")))


class CutWords:
    """The whole words, and a store of their pieces that rounds work on until the whole words are counted anew.

    A token made of others occurs at most as often as any pair of tokens beside each other in it, so while
    merges count more than ``floor`` none crosses a pair at or below it.  Pairs above the floor are counted
    exactly by the pieces; the others stay at or below it.
    """

    def __init__(self, words: DataFrame, parts: int, max_id: int, checkpoint_every: int, open_pieces):
        self.every, self.round, self.max_id, self.open_pieces = max(1, checkpoint_every), 0, max_id, open_pieces
        self.words = self._keep(words.where(F.length("seq") >= 2).repartition(parts))
        self.old: DataFrame | None = None
        self.pieces, self.floor, self.kept, self.pending = None, 0, {}, []

    def _keep(self, df: DataFrame) -> DataFrame:
        self.round += 1
        if self.round % self.every == 0:
            return df.checkpoint(eager=True)
        return df.persist(StorageLevel.MEMORY_AND_DISK)

    def counts(self) -> DataFrame:
        """Counts of all pairs in the whole words as of now."""
        if self.pending:
            self._drop_pieces()
            if self.old is not None:
                self.old.unpersist()  # `words` was counted, so it is there
            self.old = self.words
            self.words = self._keep(self.words.selectExpr(f"{replayed_sql('seq', self.pending)} AS seq", "n").where("length(seq) >= 2"))
            self.pending = []
        return pair_counts(self.words, max_id=self.max_id)

    def cut(self, floor: int, kept: dict[tuple[int, int], int]) -> None:
        """Work on pieces until counts sink to ``floor``; ``kept``: all pairs above it."""
        self.floor, self.kept = floor, dict(kept)

    def above_floor(self) -> DataFrame | None:
        """Counts of all pairs above the floor, from the pieces."""
        return self.pieces.counts().where(F.col("n") > self.floor) if self.pieces else None

    def apply(self, merges: Sequence[Merge], pairs, first_new: int, bound: int):
        if self.pieces is None and self.kept:
            self.pieces = self.open_pieces(cut_pieces(self.words, self.kept), self.max_id)
        self.max_id = max(self.max_id, *(m[2] for m in merges))
        self.pending += merges
        return self.pieces.apply(merges, pairs, first_new, bound) if self.pieces else []

    def _drop_pieces(self) -> None:
        if self.pieces is not None:
            self.pieces.close()
        self.pieces, self.kept = None, {}

    def close(self) -> None:
        self._drop_pieces()
        for df in (self.old, self.words):
            if df is not None:
                df.unpersist()


def open_store(spark: SparkSession, words: DataFrame, cfg, parts: int, max_id: int) -> CutWords:
    buckets = cfg.buckets or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def open_pieces(pieces: DataFrame, top_id: int):
        if cfg.count_mode == "index":
            return WordIndex(spark, pieces, top_id, buckets, cfg.fold_every)
        return ScanWords(spark, pieces, parts, top_id, cfg.checkpoint_every, buckets if cfg.count_mode == "delta" else 0, cfg.fold_every)

    return CutWords(words.select("seq", F.col("n").cast("bigint").alias("n")), parts, max_id, cfg.checkpoint_every, open_pieces)


def merge_rounds(store: CutWords, cfg, vocab: dict[int, bytes], kinds: dict[int, str], vocab_table):
    """Yield (merges of a round, top count, was there a recount) until the budget or the pairs are used up.

    ``vocab`` and ``kinds`` grow with the merges; ``vocab_table(vocab, kinds)`` gives them as a frame.
    A batch that takes every known pair may be cut short by the bound, so the pairs are counted before it.
    """
    from pairforge.plans.train import _next_free, accept_batch, rank_candidates

    budget = max(0, cfg.vocab_size - len(vocab))
    next_id = _next_free(vocab, 256)
    size = max(2, cfg.candidates)
    front = Frontier(size)

    def batch() -> list[tuple[int, int, int]]:
        return accept_batch(rank_candidates([(*p, n) for p, n in front.known.items()], vocab), False, budget, cfg.batch_merges)

    def spent() -> bool:
        return len(chosen) == len(front.known) and len(chosen) < budget

    def top(counts: DataFrame) -> list[tuple[str, int]]:
        return [(r["pair"], int(r["n"])) for r in counts.orderBy(F.desc("n")).limit(size).collect()]

    while budget > 0:
        chosen, recount = batch(), False
        if spent() and front.bound > store.floor and store.pieces:  # pairs that the frontier forgot
            recount = True
            front.load(top(store.above_floor()), store.floor)
            chosen = batch()
        if not chosen or spent() and front.bound > 0:
            recount = True
            rows = top(store.counts())
            if not rows:
                return
            front.load(rows)
            chosen = batch()
            if chosen:
                front.lift(min(rows[0][1] // FLOOR_SHARE, chosen[-1][2] - 1))
                store.cut(front.bound, front.known)
            else:  # all counted pairs tie: rank that level by bytes in Spark
                level = store.counts().where(F.col("n") == rows[0][1])
                best = top_pairs(level, vocab_table(vocab, kinds), 1).select("left", "right", "n").first()
                chosen = [(int(best["left"]), int(best["right"]), int(best["n"]))]
        new: list[Merge] = []
        for a, b, _ in chosen:
            vocab[next_id], kinds[next_id] = vocab[a] + vocab[b], "merge"
            new.append((a, b, next_id))
            next_id = _next_free(vocab, next_id + 1)
        budget -= len(new)
        if budget > 0:
            front.update(store.apply(new, front.touched(new), new[0][2], front.bound))
        yield new, chosen[0][2], recount
