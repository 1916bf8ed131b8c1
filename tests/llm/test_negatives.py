"""Operator 13 against brute force over all pairs."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from pairforge.llm import hard_negatives

NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return df.selectExpr("*", *[f"'x' AS {n}" for n in ("q", "v", "m", "ids", "labels", "dim", "block", "share", "score", "positive", "anchor_id", "id")])


def brute(rows, n_positives=5, n_negatives=3):
    best = {}
    for i, e, label in rows:
        if i is None or e is None or label is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in e]
        if i not in best or (label, q) < best[i][:2]:
            best[i] = (label, q, (label + 1) % 10 if i % 7 == 0 else label)
    out = []
    for a in best:
        if a % 50:
            continue
        scored = defaultdict(list)
        for i, (_, q, label) in best.items():
            if i != a and len(q) == len(best[a][1]):
                scored[label == best[a][2]].append((-sum(x * y for x, y in zip(q, best[a][1])), i))
        for ps, p in sorted(scored[True])[:n_positives]:
            fit = [(s, n) for s, n in sorted(scored[False]) if 50 * -ps <= 100 * -s <= 95 * -ps][:n_negatives]
            out += [(a, p, k, n, -ps, -s) for k, (s, n) in enumerate(fit, 1)]
    return sorted(out)


def got(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in df.collect())


def vectors(n, dim, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, dim))
    at = rng.integers(0, 6, n)
    m = (centre[at] + spread * rng.normal(size=(n, dim))).astype("float32")
    return [(int(i), [float(x) for x in v], int(k)) for i, v, k in zip(rng.permutation(3 * n)[:n], m, at)]


@pytest.mark.parametrize("block,share", [(4096, 256), (3, 1)])
def test_negatives_equal_brute_force(spark, monkeypatch, block, share):
    monkeypatch.setattr(hard_negatives, "CHUNK", 64)
    rows = vectors(700, 8, 1)
    df = table(spark, rows).repartition(5)
    found = got(hard_negatives.mine(hard_negatives.quantised(df), anchors_a_block=block, chunks_a_share=share))
    assert found == brute(rows) and len(found) > 50


def test_negatives_with_ties_and_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "CHUNK", 16)
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.01, 0.0, 0.004, 0.5]) for _ in range(3)], rng.choice([0, 0, 1, 2, 9])) for i in range(-60, 260)]
    rows += [(300, [0.1, 0.2], 1), (301, [0.3, 0.1], 1), (302, [0.2, 0.1], 2), (350, [], 1), (351, [], 1), (352, [], 3)]
    rows += [(400, None, 1), (450, [1.0, None, 0.0], 1), (500, [NAN, 1.0, 0.0], 1), (550, [INF, 0.0, 0.0], 1), (600, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1)]
    rows += [(650, [0.5, 0.5, 0.5], 3), (650, [0.5, 0.5, 0.5], 3), (650, [0.1, 0.5, 0.5], 2)]  # repeated ids
    rows += [(700, [1.0, 0.0, 0.0], 77)]  # a label of its own: no positive
    assert got(hard_negatives.mine(hard_negatives.quantised(table(spark, rows).repartition(4)))) == brute(rows)


def test_negatives_where_one_label_holds_most_rows(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "CHUNK", 128)
    rows = [(i, e, 0 if i % 3 else 1 + i % 2) for i, e, _ in vectors(900, 4, 2)] + [(5000 + i, [0.5] * 4, 0) for i in range(300)]
    assert got(hard_negatives.mine(hard_negatives.quantised(table(spark, rows).repartition(3)))) == brute(rows)


def test_negatives_of_nothing_and_of_huge_values(spark):
    assert got(hard_negatives.mine(hard_negatives.quantised(table(spark, [])))) == []
    rows = [(0, [3e38, 1.0], 1), (1, [3e38, 2.0], 1), (2, [1.6e38, 0.0], 2)]
    assert hard_negatives.mine(hard_negatives.quantised(table(spark, rows))).count() >= 0


def test_best_keeps_the_earliest_of_ties():
    rng = np.random.default_rng(5)
    for _ in range(50):
        rows, keep = int(rng.integers(1, 12)), int(rng.integers(1, 6))
        s = rng.integers(-2, 3, (rows, 4))
        fits = rng.random((rows, 4)) < 0.7
        ids = np.sort(rng.permutation(40)[:rows])
        gs, gi = hard_negatives.best(s, fits, ids, keep)
        for c in range(4):
            want = sorted((-s[r, c], ids[r]) for r in range(rows) if fits[r, c])[:keep]
            have = [(-a, b) for a, b in zip(gs[c], gi[c]) if a > hard_negatives.NONE]
            assert have == want
