"""Tiny literal fixtures: pair counts, merges, tie-break, round trip."""

from pyspark.sql import functions as F

from pairforge.functions.udfs import bpe_ids
from pairforge.operators.merges import apply_merges_to_ids
from pairforge.operators.pairs import pair_counts_of_ids, top_pairs, pair_counts
from pairforge.operators.vocab import initial_vocab, vocab_frame
from pairforge.plans.train import accept_batch, rank_candidates

SAMPLE = [[1, 2, 3, 1, 2], [1, 2, 1, 2], [5, 6, 7]]


def test_pair_counts_literal(spark):
    df = spark.createDataFrame([(s,) for s in SAMPLE], "ids array<int>")
    got = {(r.left, r.right): r.n for r in pair_counts_of_ids(df).collect()}
    assert got == {(1, 2): 4, (2, 3): 1, (3, 1): 1, (2, 1): 1, (5, 6): 1, (6, 7): 1}


def test_get_stats_single(spark):
    df = spark.createDataFrame([([1, 2, 3, 1, 2],)], "ids array<int>")
    got = {(r.left, r.right): r.n for r in pair_counts_of_ids(df).collect()}
    assert got == {(1, 2): 2, (2, 3): 1, (3, 1): 1}


def test_apply_merge_all(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLE)], "k int, ids array<int>")
    got = [list(r.ids) for r in apply_merges_to_ids(df, [(1, 2, 100)]).orderBy("k").collect()]
    assert got == [[100, 3, 100], [100, 100], [5, 6, 7]]


def test_merge_single_and_overlap(spark):
    df = spark.createDataFrame([(0, [1, 2, 3, 1, 2]), (1, [97, 97, 97]), (2, [97, 97, 97, 97])],
                               "k int, ids array<int>")
    got = [list(r.ids) for r in apply_merges_to_ids(df, [(1, 2, 4), (97, 97, 300)]).orderBy("k").collect()]
    assert got == [[4, 3, 4], [300, 97], [300, 300]]


def test_large_ids_survive_surrogate_gap(spark):
    ids = [55295, 55296, 60000, 70000, 1_000_000]
    df = spark.createDataFrame([(ids,)], "ids array<int>")
    assert list(apply_merges_to_ids(df, []).first().ids) == ids


def test_tie_break_driver_and_spark(spark):
    vocab, _ = initial_vocab([])
    counts = [(0, 1, 2), (1, 2, 3), (2, 2, 3), (2, 1, 3)]
    assert rank_candidates(counts, vocab)[0][:2] == (2, 2)
    from pairforge.functions.expressions import ids_to_seq
    pc = spark.createDataFrame([(ids_to_seq([a, b]), n) for a, b, n in counts], "pair string, n bigint")
    best = top_pairs(pc, vocab_frame(spark, vocab), 1).first()
    assert (best.left, best.right) == (2, 2)


def test_bytes_order_is_unsigned_prefix_smaller():
    vocab = {0: b"\x80", 1: b"a", 2: b"ab", 3: b"b"}
    ranked = rank_candidates([(1, 3, 5), (2, 3, 5), (0, 3, 5)], vocab)
    assert [r[0] for r in ranked] == [0, 2, 1]


def test_accept_batch_rules():
    # (a,b) accepted; (b,c) overlaps its right side -> stop
    assert accept_batch([(1, 2, 10), (2, 3, 9)], False, 10) == [(1, 2, 10)]
    # independent pairs, no blockers -> both
    assert accept_batch([(1, 2, 10), (5, 6, 9), (7, 8, 1)], False, 10) == [(1, 2, 10), (5, 6, 9), (7, 8, 1)]
    # a pair (x, 1) with count >= 9 could create (x, new) outranking (5, 6)
    assert accept_batch([(1, 2, 10), (9, 1, 9), (5, 6, 9)], False, 10) == [(1, 2, 10)]
    # self pair stops the batch
    assert accept_batch([(1, 1, 10), (5, 6, 9)], False, 10) == [(1, 1, 10)]
    # unseen ties at the cut
    assert accept_batch([(1, 2, 10), (5, 6, 4), (7, 8, 4)], True, 10) == [(1, 2, 10)]
    # budget
    assert accept_batch([(1, 2, 10), (5, 6, 9)], False, 1) == [(1, 2, 10)]
    assert accept_batch([(1, 2, 10)], False, 0) == []


def test_bpe_ids_replays_merge_order():
    table = {(97, 97): (0, 300), (300, 97): (1, 301)}
    assert bpe_ids([97, 97, 97], table) == [301]
    assert bpe_ids([97, 97, 97, 97], table) == [300, 300]


def test_pair_counts_strings_count_overlaps(spark):
    from pairforge.functions.expressions import ids_to_seq
    words = spark.createDataFrame([(ids_to_seq([97, 97, 97]), 2)], "seq string, n bigint")
    got = {r.pair: r.n for r in pair_counts(words).collect()}
    assert got == {ids_to_seq([97, 97]): 4}


def test_longest_token_forms(spark):
    from pairforge.operators.vocab import longest_token
    # b"\xc3\xa9" is 2 bytes and 2 alphabet characters; b" \n\t" is 3 bytes / 3 chars; ties -> smaller id
    vocab = {0: b"ab", 1: b" \n\t", 2: b"xyz", 3: b"\xc3\xa9"}
    df = vocab_frame(spark, vocab)
    assert longest_token(df).first().id == 1
    assert longest_token(df, by="chars").first().id == 1
    assert longest_token(df).first().n_bytes == 3
