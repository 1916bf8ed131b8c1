"""Training: golden file, batched == one-at-a-time, delta == recount, edge cases."""

import json
import os

import pytest
from pyspark.sql import functions as F

from pairforge.functions.patterns import byte_alphabet
from pairforge.operators.pretokenize import training_words, word_counts
from pairforge.plans.train import TrainConfig, train, train_words
from tests.conftest import GOLDEN_DIR


def _train_texts(spark, texts, **kw):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    return train(spark, df, TrainConfig(**kw))


if GOLDEN_DIR:
    def test_golden_corpus(spark):
        from pairforge.sources.bundle import read_merges_text, read_vocab_json
        from pairforge.sources.corpus import read_text_records
        docs = read_text_records(spark, f"{GOLDEN_DIR}/corpus.en")
        m = train(spark, docs, TrainConfig(vocab_size=500))
        gold = [(bytes(r.left_bytes), bytes(r.right_bytes))
                for r in read_merges_text(spark, f"{GOLDEN_DIR}/train-bpe-reference-merges.txt").orderBy("rank").collect()]
        assert m.merges_bytes() == gold
        gv = read_vocab_json(spark, f"{GOLDEN_DIR}/train-bpe-reference-vocab.json").collect()
        assert set(m.vocab.values()) == {bytes(r.bytes) for r in gv}
        assert set(m.vocab) == {r.id for r in gv}
        first = m.relabel_specials_first()
        assert {r.id: bytes(r.bytes) for r in gv} == first.vocab


def test_batched_equals_one_at_a_time(spark, small_docs):
    words = training_words(word_counts(small_docs)).persist()
    one = train_words(spark, words, TrainConfig(vocab_size=310, batch_merges=False, count_mode="recount"))
    many = train_words(spark, words, TrainConfig(vocab_size=310, candidates=64))
    assert many.merges == one.merges
    assert len(many.rounds) < len(one.rounds)


def test_delta_equals_recount(spark, small_docs):
    words = training_words(word_counts(small_docs)).persist()
    a = train_words(spark, words, TrainConfig(vocab_size=330, count_mode="recount"))
    b = train_words(spark, words, TrainConfig(vocab_size=330, count_mode="delta", checkpoint_every=3))
    assert a.merges == b.merges


def weighted_brute_force(words, vocab_size):
    """One merge at a time over distinct words and their counts: the golden answer for a corpus of any size."""
    from collections import Counter
    vocab = {i: bytes([i]) for i in range(256)} | {256: b"<|endoftext|>"}
    seqs = [(list(w.encode()), n) for w, n in words]
    merges = []
    while len(vocab) < vocab_size:
        counts = Counter()
        for q, n in seqs:
            for p in zip(q, q[1:]):
                counts[p] += n
        if not counts:
            break
        best = max(counts, key=lambda p: (counts[p], vocab[p[0]], vocab[p[1]], -p[0], -p[1]))
        new = len(vocab)
        vocab[new] = vocab[best[0]] + vocab[best[1]]
        merges.append((*best, new))
        for q, _ in seqs:
            i = 0
            while i < len(q) - 1:
                if (q[i], q[i + 1]) == best:
                    q[i:i + 2] = [new]
                i += 1
    return merges


def test_golden_training_of_a_corpus(spark, small_docs):
    """About 130 KB of text to vocabulary 500, the size of the published example, against brute force."""
    lines = small_docs.where("doc_id % 3 = 0").selectExpr("doc_id", "substr(text, 1, 2500) AS text")
    words = training_words(word_counts(lines)).persist()
    plain = [(r.word, r.n) for r in word_counts(lines).collect()]
    want = weighted_brute_force(plain, 500)
    got = {mode: train_words(spark, words, TrainConfig(vocab_size=500, count_mode=mode, candidates=300))
           for mode in ("frontier", "recount")}
    assert all(m.merges == want for m in got.values()) and len(want) == 243
    rounds = got["frontier"].rounds
    assert sum(r.recount for r in rounds) < len(rounds) == len(got["recount"].rounds)


@pytest.mark.parametrize("mode,size,fold", [("frontier", 8, 8), ("frontier", 2, 8), ("delta", 40, 2), ("index", 300, 2)])
def test_incremental_modes_equal_brute_force(spark, mode, size, fold):
    texts = ["the cat sat on the mat, the hat", "aaaa aaa aa a abab baba", "then there these those them", "x" * 40 + " yx yx yxx", "it's 'quoted' \\ \u00e9\U0001f600 \x01"]
    m = _train_texts(spark, texts, vocab_size=276, special_tokens=[], count_mode=mode, candidates=size, fold_every=fold,
                     checkpoint_every=3, buckets=4)
    assert m.merges_bytes() == brute_force(texts, 276, [])


def test_index_lookup_reads_few_buckets_and_no_words(spark, small_docs):
    from pairforge.operators.pairs import pair_index
    from pairforge.plans.incremental import WordIndex
    from pairforge.session import spill_table
    own = spark.newSession()
    own.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # as training does
    words = spill_table(training_words(word_counts(small_docs)).select("seq", F.col("n").cast("bigint").alias("n")), "test-words")
    store = WordIndex(own, words, 256, buckets=32, fold_every=3)
    merges = weighted_brute_force([(r.word, r.n) for r in word_counts(small_docs).collect()], 257 + 5)
    for m in merges:
        store.apply([m], [], m[2], 0)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    late = plan(store.lookup([merges[-1]]))
    assert "SelectedBucketsCount: 1 out of 32" in late and "index-words" not in late and late.count("FileScan") == 1
    # counts and the index are summed up inside their buckets: no exchange carries the table
    assert "hashpartitioning" not in plan(store.counts()) and "hashpartitioning" not in plan(store.index())
    from pairforge.operators.merges import merge_expr
    after = words.withColumn("word_id", F.xxhash64("seq")).withColumn("seq", merge_expr("seq", merges))
    want = pair_index(after).groupBy("pair").count()
    got = store.index().groupBy("pair").count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    from pairforge.operators.pairs import pair_counts
    assert store.counts().exceptAll(pair_counts(after)).count() == 0 == pair_counts(after).exceptAll(store.counts()).count()
    store.close()


def test_words_are_cut_where_no_kept_pair_is(spark):
    from pairforge.functions.expressions import char_to_id, id_to_char, ids_to_seq
    from pairforge.operators.merges import merge_expr
    from pairforge.plans.incremental import cut_pieces, replayed_sql
    kept = {(97, 98): 9, (98, 97): 4, (93, 94): 3, (92, 45): 3, (45, 93): 1, (10, 91): 2, (0xD800, 0xF800): 5, (0xF800, 39): 1}
    words = [("ababa", 2), ("abxbab", 3), ("]^\\-]", 1), ("\n[\n[]^", 5), (ids_to_seq([0xD800, 0xF800, 39, 0xD800, 0xF800]), 7), ("a", 4), ("xyz", 1), ("ab" * 100_000, 1)]
    want = {}
    for word, n in words:
        ids = [char_to_id(c) for c in word]
        piece = [ids[0]]
        for pair in zip(ids, ids[1:]):
            if pair not in kept:
                want[tuple(piece)] = want.get(tuple(piece), 0) + n
                piece = []
            piece.append(pair[1])
        want[tuple(piece)] = want.get(tuple(piece), 0) + n
    frame = spark.createDataFrame(words, "seq string, n bigint")
    got = {tuple(char_to_id(c) for c in r.seq): r.n for r in cut_pieces(frame, kept).collect()}
    assert got == {k: n for k, n in want.items() if len(k) > 1}
    merges = [(97, 98, 300), (300, 300, 301), (300, 97, 302), (93, 94, 303)]
    same = frame.select(merge_expr("seq", merges).alias("a"), F.expr(replayed_sql("seq", merges)).alias("b"))
    assert same.where("a = b").count() == len(words)
    # far more merges than an expression could nest
    long = [(97 + i % 20, 98 + i % 20, 400 + i) for i in range(3000)]
    assert spark.createDataFrame([("zabz",)], "seq string").selectExpr(replayed_sql("seq", long)).first()[0] == f"z{id_to_char(400)}z"


def _rows_of_rounds(spark, mode):
    """Train over 1,500 rare words and a few common ones; the rows that each round worked on."""
    import random

    from pairforge.operators.vocab import initial_vocab
    from pairforge.plans.incremental import merge_rounds, open_store
    rng = random.Random(5)
    words = {"".join(rng.choice("bcdefghijklmnopqrsuvwxyz") for _ in range(9)): 1 for _ in range(1500)}
    words |= {" the": 5000, " then": 3000, " that": 2000, "tttt": 900}
    vocab, kinds = initial_vocab(["<|endoftext|>"])
    frame = spark.createDataFrame([(w, n) for w, n in words.items()], "seq string, n bigint").repartition(3)
    own = spark.newSession()
    own.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # as training does
    store = open_store(own, frame, TrainConfig(vocab_size=257 + 6, count_mode=mode, buckets=4, checkpoint_every=3), 3, 256)
    merges, rows = [], []
    for new, _, _ in merge_rounds(store, TrainConfig(vocab_size=257 + 6, count_mode=mode, buckets=4), vocab, kinds, None):
        merges += new
        if store.pieces:
            rows.append(store.pieces.index().select("word_id").distinct().count() if mode == "index" else store.pieces.cur.count())
    store.close()
    assert merges == weighted_brute_force(list(words.items()), 257 + 6)
    return rows, len(words)


def test_rounds_of_index_work_on_pieces(spark):
    rows, words = _rows_of_rounds(spark, "index")
    assert rows and max(rows) < words / 20


def test_rounds_of_frontier_work_on_pieces(spark):
    rows, words = _rows_of_rounds(spark, "frontier")
    assert rows and max(rows) < words / 20


def test_rounds_of_delta_work_on_pieces(spark):
    rows, words = _rows_of_rounds(spark, "delta")
    assert rows and max(rows) < words / 20


def test_frontier_bound_covers_what_it_forgets():
    from pairforge.plans.incremental import Frontier
    f = Frontier(3)
    f.load([("ab", 9), ("cd", 7), ("ef", 7)])
    assert f.bound == 7 and f.known == {(97, 98): 9}
    f.update([((97, 98), -1), ((256, 1), 20), ((256, 2), 7)])
    assert f.known == {(97, 98): 8, (256, 1): 20}
    f.update([((300, i), 10 + i) for i in range(14)])
    assert len(f.known) <= 12 and all(n > f.bound for n in f.known.values()) and f.bound >= 7
    f.load([("ab", 2)])
    assert f.bound == 0 and f.known == {(97, 98): 2}


def test_partition_count_independent(spark, small_docs):
    a = train(spark, small_docs.repartition(1), TrainConfig(vocab_size=300))
    b = train(spark, small_docs.repartition(9), TrainConfig(vocab_size=300, word_partitions=5))
    assert a.merges == b.merges


def test_small_candidate_window_still_exact(spark, small_docs):
    words = training_words(word_counts(small_docs)).persist()
    a = train_words(spark, words, TrainConfig(vocab_size=300, candidates=2))
    b = train_words(spark, words, TrainConfig(vocab_size=300, batch_merges=False))
    assert a.merges == b.merges


def test_pairs_exhausted_before_vocab_size(spark):
    m = _train_texts(spark, ["aaaa aaaa"], vocab_size=1000)
    assert len(m.vocab) < 1000
    assert m.merges_bytes()[0] == (b"a", b"a")


def test_vocab_size_below_initial(spark):
    m = _train_texts(spark, ["hello"], vocab_size=10)
    assert m.merges == [] and len(m.vocab) == 257


def test_overlap_counting_and_merge(spark):
    m = _train_texts(spark, ["aaa"], vocab_size=259, special_tokens=[])
    assert m.merges_bytes() == [(b"a", b"a"), (b"aa", b"a")]


def test_specials_never_merged(spark):
    m = _train_texts(spark, ["ab<|endoftext|>ab<|endoftext|>ab<|endoftext|>"], vocab_size=270)
    for a, b in m.merges_bytes():
        assert b"<|" not in a + b or (a + b).count(b"<|endoftext|>") == 0
    assert 256 in m.vocab and m.vocab[256] == b"<|endoftext|>"


def test_duplicate_specials_get_two_ids(spark):
    m = _train_texts(spark, ["x"], vocab_size=10, special_tokens=["<s>", "<s>"])
    assert m.vocab[256] == m.vocab[257] == b"<s>"


def test_empty_corpus(spark):
    m = _train_texts(spark, [""], vocab_size=300)
    assert m.merges == []


def brute_force(texts, vocab_size, specials):
    """Plain one-at-a-time trainer over every pre-token occurrence (test oracle)."""
    import regex
    from pairforge.functions.patterns import PRETOKEN_PATTERN
    vocab = {i: bytes([i]) for i in range(256)}
    for s in specials:
        vocab[len(vocab)] = s.encode()
    split = regex.compile("|".join(regex.escape(s) for s in specials)) if specials else None
    seqs = []
    for t in texts:
        for doc in (split.split(t) if split else [t]):
            seqs += [list(m.encode()) for m in regex.findall(PRETOKEN_PATTERN, doc)]
    merges = []
    while len(vocab) < vocab_size:
        counts = {}
        for q in seqs:
            for p in zip(q, q[1:]):
                counts[p] = counts.get(p, 0) + 1
        if not counts:
            break
        best = max(counts, key=lambda p: (counts[p], vocab[p[0]], vocab[p[1]]))
        new = len(vocab)
        vocab[new] = vocab[best[0]] + vocab[best[1]]
        merges.append((vocab[best[0]], vocab[best[1]]))
        out = []
        for q in seqs:
            r, i = [], 0
            while i < len(q):
                if i + 1 < len(q) and (q[i], q[i + 1]) == best:
                    r.append(new)
                    i += 2
                else:
                    r.append(q[i])
                    i += 1
            out.append(r)
        seqs = out
    return merges


@pytest.mark.parametrize("texts,size,specials", [
    (["a \t\n  b   c\n\n\nd"] * 3, 262, []),
    (["aaaa aaa aa a", "abab abab", "ba ba ba"], 270, []),
    (["the cat<|endoftext|>the hat<|endoftext|> the  thin   theme\n"], 280, ["<|endoftext|>"]),
    (["x" * 40 + " " + "xy" * 10, "yx yx yxx"], 275, []),
])
def test_against_brute_force(spark, texts, size, specials):
    m = _train_texts(spark, texts, vocab_size=size, special_tokens=specials, candidates=4)
    assert m.merges_bytes() == brute_force(texts, size, specials)


@pytest.mark.parametrize("mode", ["recount", "delta"])
def test_speculation_against_brute_force(spark, mode):
    texts = ["the cat sat on the mat, the hat", "aaaa aaa aa a abab baba", "then there these those them"]
    m = _train_texts(spark, texts, vocab_size=300, special_tokens=[], speculate=8, count_mode=mode,
                     checkpoint_every=3)
    assert m.merges_bytes() == brute_force(texts, 300, [])


def test_verify_speculation_rules():
    from pairforge.plans.train import verify_speculation
    vocab = {i: bytes([i]) for i in range(256)}
    cands = [(1, 2, 10), (3, 4, 8), (5, 6, 3)]
    steps = [(1, 2, 256), (3, 4, 257), (5, 6, 258)]
    # merging (1,2) creates (256, 7) with count 9 > 8: it is the true second merge
    deltas = {1: [((1, 2), -10), ((256, 7), 9), ((2, 7), -9)], 2: [((3, 4), -8)]}
    assert verify_speculation(cands, False, steps, deltas, vocab, 10, allow_extra=True) == [(1, 2), (256, 7)]
    assert verify_speculation(cands, False, steps, deltas, vocab, 10, allow_extra=False) == [(1, 2)]
    # unseen pairs may reach the last fetched count
    assert verify_speculation(cands, True, steps, {1: [((1, 2), -10)], 2: [((3, 4), -8)]}, vocab, 10,
                              allow_extra=True) == [(1, 2), (3, 4)]


def test_brute_force_on_documents(spark, small_docs):
    texts = [r.text for r in small_docs.where("doc_id % 10 = 3").collect()]
    m = _train_texts(spark, texts, vocab_size=300, special_tokens=["<|endoftext|>"])
    assert m.merges_bytes() == brute_force(texts, 300, ["<|endoftext|>"])


def test_observed_alphabet_and_unk(spark):
    from pairforge.operators.encode import encode_texts
    from pairforge.operators.decode import decode
    m = _train_texts(spark, ["abab abab cab"], vocab_size=12, special_tokens=[], initial_alphabet="observed",
                     unk_token="<unk>")
    byte_ids = [i for i, k in m.kinds.items() if k == "byte"]
    assert sorted(byte_ids) == [32, 97, 98, 99]
    assert len(m.vocab) <= 12 and len(m.merges) == len(m.vocab) - 5
    unk = m.special_ids()["<unk>"]
    ids = encode_texts(spark, m, ["abz"])[0]
    assert ids[-1] == unk
    df = spark.createDataFrame([(ids,)], "ids array<int>")
    assert decode(df, m, skip_special_tokens=True).first().decoded.startswith("ab")
