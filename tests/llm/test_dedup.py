"""Operators over pairs of rows: suffix-array dedup, embeddings, SimHash, components."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from helpers import awkward, empty, frame, prose

from pairforge.llm import embed_dedup, graph, simhash, suffix_dedup


# 2. suffix array

def brute_removed(texts, length):
    seen, out = set(), []
    for b in texts:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            x = b[s:s + length]
            if x in seen:
                gone[s:s + length] = b"\1" * length
            seen.add(x)
        out.append(gone)
    return out


def brute_digests(rows, length):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    texts = [(rows[i][1] or "").encode() for i in order]
    want = collections.Counter()
    for i, b, g in zip(order, texts, brute_removed(texts, length)):
        spans = sum(g[x] and (x == 0 or not g[x - 1]) for x in range(len(b)))
        kept = bytes(c for c, m in zip(b, g) if not m)
        want[rows[i][0], len(b), sum(g), spans, hashlib.sha256(kept).hexdigest()] += 1
    return want


def digests(df):
    return collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_suffix_dedup_of_awkward_documents(spark):
    rows = awkward()
    assert digests(suffix_dedup.repeat_digests(frame(spark, rows, clash=True).coalesce(1))) == brute_digests(rows, 100)
    assert suffix_dedup.repeat_digests(empty(spark)).count() == 0


@pytest.mark.parametrize("hot", [50_000, 3])
def test_suffix_dedup_of_dense_repeats(spark, hot):
    rng = random.Random(17)
    passages = ["".join(rng.choices("ab", k=rng.randint(20, 90))) for _ in range(8)]
    rows = [(i, "".join(rng.choice(passages) + "".join(rng.choices("abc", k=rng.randint(0, 9)))
                        for _ in range(rng.randint(0, 8)))) for i in range(60)]
    rng.shuffle(rows)
    got = suffix_dedup.repeat_digests(frame(spark, rows).repartition(5), length=40, k=16, chunk_bytes=2000, hot=hot)
    assert digests(got) == brute_digests(rows, 40)


def test_sort_suffixes_with_ties_beyond_the_first_words():
    rng = random.Random(3)
    stem = "".join(rng.choices("ab", k=300))
    texts = []
    for i in range(40):
        x = list(stem)
        for _ in range(rng.randint(0, 3)):
            x[rng.randrange(300)] = "c"
        texts.append("".join(x).encode())
    data = b"".join(texts)
    pos = np.array([300 * i + j for i in range(40) for j in range(0, 200, 7)])
    groups = np.array([j % 3 for i in range(40) for j in range(0, 200, 7)])
    for block in (1 << 20, 50):
        seen = []
        for order, agrees in suffix_dedup.sort_suffixes(data, pos, groups, 100, block):
            keys = [(groups[i], data[pos[i]:pos[i] + 100]) for i in order]
            assert keys == sorted(keys)
            assert list(agrees) == [False] + [a == b for a, b in zip(keys, keys[1:])]
            seen += list(order)
        assert sorted(seen) == list(range(len(pos)))


def test_remove_repeats_keeps_columns_and_valid_text(spark):
    rows = awkward()
    docs = frame(spark, rows, clash=True).coalesce(1)
    got = suffix_dedup.remove_repeats(docs)
    assert got.columns == docs.columns
    have = collections.defaultdict(list)
    for r in got.collect():
        have[r.doc_id].append(r)
    assert len(have[12]) == 2 and sorted(len(r.text) for r in have[12])[0] == 0
    assert have[3][0].text is None and have[4][0].text == "" and have[7][0].text == ""
    assert have[1][0].text == rows[0][1] and have[7][0].kept == "kept7"
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


# 10. SimHash

def brute_fp(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    sh = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    from xxhash import xxh64_intdigest

    hs = [xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if hs and 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_classes(fps, bits):
    up = list(range(len(fps)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(fps))]


def test_fingerprints_match_the_definition(spark):
    rows = awkward() + [(50, "A B C"), (51, "É É é É x"), (52, "a b c d " * 500)]
    got = {(r.doc_id, r.text_hash): r.fp % 2**64 for r in simhash.fingerprints(frame(spark, rows, clash=True)).collect()}
    assert sorted(got.values()) == sorted({(i, t): brute_fp(t) for i, t in rows}.values())


@pytest.mark.parametrize("block", [4096, 20])
def test_simhash_classes(spark, block):
    rng = random.Random(8)
    rows = awkward() + [(100 + i, prose(rng, rng.randint(1, 30))) for i in range(60)]
    words = prose(rng, 400).split()
    for i in range(150):  # one large group of near copies
        x = list(words)
        for _ in range(rng.randint(0, 12)):
            x[rng.randrange(400)] = "z"
        rows.append((300 + i, " ".join(x)))
    fps = [brute_fp(t) for _, t in rows]
    top = brute_classes(fps, 4)
    low = {c: min((rows[i][0] for i in range(len(rows)) if top[i] == c and rows[i][0] is not None), default=None) for c in set(top)}
    got = collections.Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.classes(frame(spark, rows), block=block).collect())
    assert got == collections.Counter((i, f, low[c]) for (i, _), f, c in zip(rows, fps, top))


def test_simhash_edges_over_random_fingerprints(spark):
    rng = random.Random(21)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for f in list(fps)[:150]:
        for _ in range(3):
            g = f
            for b in rng.sample(range(64), rng.randint(1, 6)):
                g ^= 1 << b
            fps.add(g)
    fps = sorted(fps)
    df = spark.createDataFrame([(f - 2**64 if f >> 63 else f,) for f in fps], "fp long")
    links = [(r.a % 2**64, r.b % 2**64) for r in simhash.link_edges(df).collect()]
    at = {f: i for i, f in enumerate(fps)}
    up = list(range(len(fps)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        assert (a ^ b).bit_count() <= 4 or len(links) > 0
        x, y = top(at[a]), top(at[b])
        up[max(x, y)] = min(x, y)
    assert [top(i) for i in range(len(fps))] == brute_classes(fps, 4)


def test_allocation_covers_every_pair():
    rng = np.random.default_rng(1)
    for n in (0, 1, 10, 2000):
        for rows in (10, 10**6, 10**10):
            sample = rng.integers(0, 2**63, n).astype("u8")
            plan = simhash.allocate(sample, rows, 4)
            parts = len(plan)
            masks = [m for m, _ in plan]
            assert all(a & b == 0 for i, a in enumerate(masks) for b in masks[:i])
            # the pigeonhole: thresholds plus one of all partitions, skipped ones counting nothing, sum to max + 1
            assert sum(t + 1 for _, t in plan) == 5 and parts >= 1


def test_keep_one(spark):
    rows = awkward()
    docs = frame(spark, rows, clash=True)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    fps = [brute_fp(t) for _, t in rows]
    top = brute_classes(fps, 4)
    want = []
    for c in set(top):
        ids = [rows[i][0] for i in range(len(rows)) if top[i] == c]
        want.append(min((i for i in ids if i is not None), default=None))
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter(want)
    assert simhash.keep_one(empty(spark)).count() == 0


# 7. embeddings

def brute_links(vectors):
    n = len(vectors)
    ok = [v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    near = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], "f8"), np.array(vectors[j], "f8")
                near[i, j] = near[j, i] = a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.9
    return near


@pytest.mark.parametrize("options", [{}, {"block": 64, "window": 8}])
def test_embeddings(spark, options):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((150, 32))
    vectors = [v for v in base]
    vectors += [base[i] + 0.15 * rng.standard_normal(32) for i in range(40) for _ in range(3)]
    vectors += [base[0] + 0.1 * rng.standard_normal(32) for _ in range(200)]
    vectors += [base[3], base[3], 2 * base[4]] + [base[5]] * 30
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    odd = [None, [0.0] * 32, [float("nan")] + [1.0] * 31, [float("inf")] * 32, [None] + [1.0] * 31, [1.0, 2.0], [2.0, 4.0], [], [0.0, 0.0]]
    rows += [(5000 + i, v) for i, v in enumerate(odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("key", graph.F.lit("clash"))
    near = brute_links([v for _, v in rows])
    lab = np.array([i for i, _ in rows])
    while True:
        new = np.array([min([lab[i], *lab[near[i]]]) for i in range(len(rows))])
        if (new == lab).all():
            break
        lab = new
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed_dedup.near_duplicates(df, **options).collect()}
    assert got == {i: (int(near[j].sum()), int(lab[j]), bool(lab[j] == i)) for j, (i, _) in enumerate(rows)}


def test_embeddings_empty(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embed_dedup.near_duplicates(none).count() == 0


@pytest.mark.parametrize("options", [{}, {"block": 256}])
def test_embeddings_in_a_crowd(spark, options):
    rng = np.random.default_rng(4)
    centre = 2 * rng.standard_normal(64)
    crowd = centre + rng.standard_normal((3000, 64))  # about 0.8 alike: no links, but neighbours in every order
    base = crowd[:150]
    across = rng.standard_normal(base.shape)
    across -= (across * base).sum(1, keepdims=True) / (base * base).sum(1, keepdims=True) * base
    unit = [m / np.linalg.norm(m, axis=1, keepdims=True) for m in (base, across)]
    crowd = np.concatenate([crowd, 0.91 * unit[0] + np.sqrt(1 - 0.91 ** 2) * unit[1]]).astype("f4")
    crowd = crowd[rng.permutation(len(crowd))]
    m = crowd.astype("f8") / np.linalg.norm(crowd.astype("f8"), axis=1, keepdims=True)
    near = (m @ m.T >= 0.9) & ~np.eye(len(m), dtype=bool)
    assert 300 <= near.sum() < 3000
    lab = np.arange(len(m))
    while True:
        new = np.minimum(lab, np.where(near, lab[None, :], len(m)).min(1))
        if (new == lab).all():
            break
        lab = new
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(crowd)], "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed_dedup.near_duplicates(df, **options).collect()}
    assert got == {i: (int(near[i].sum()), int(lab[i]), bool(lab[i] == i)) for i in range(len(m))}


def test_passes_keep_the_recall_whatever_the_density():
    rng = np.random.default_rng(5)
    one = np.ones(60_000, "int64")
    spread = rng.integers(0, 1 << 40, len(one))
    bits = [embed_dedup.cheapest_bits(one, spread, np.arange(len(one)), 40, n, 0.9, 0.999, 4096) for n in (10_000, 10**6, 10**8)]
    assert bits[0] == 0 < bits[1] < bits[2]
    agree = 1 - np.arccos(0.9) / np.pi
    for k in range(0, 41):
        assert 1 - (1 - agree ** k) ** embed_dedup.passes_for(k, 0.9, 0.999) >= 0.999


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randrange(80), 100 + rng.randrange(80)) for _ in range(60)] \
        + [(500, 500 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    up = {x: x for e in links for x in e}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    linked = {x for e in links if e[0] != e[1] for x in e}
    assert got == {x: top(x) for x in linked}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
