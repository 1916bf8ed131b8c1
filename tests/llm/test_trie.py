"""Operator 11 against a brute-force trie of the rebuilt conversations."""

import collections
import hashlib
import random
import re
import zlib

import pytest

from pairforge.llm import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def table(spark, rows, clash=True):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    if clash:
        df = df.selectExpr("*", *[f"'x' AS {n}" for n in ("at", "item", "words", "part", "path", "key", "depth", "n_convs", "up", "top", "ends")])
    return df


def conversations(rows):
    def order(r):
        role, text = r[2] or "", r[3] or ""
        told = f"{len(role.encode())}:{role}{text}".encode()
        return (r[1] is not None, r[1] or 0, role.encode(), hashlib.sha256(told).digest()[:16])

    own = collections.defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=order):
        own[r[0]].append((r[2] or "", r[3] or ""))
    return own


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    nodes = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    kids = collections.Counter(k[:-1] for k in nodes if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in nodes.items():
        gain = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in kids
            saved[k[:d]] += gain
    out = []
    for k, m in nodes.items():
        ends = sorted(c for c in m if len(convs[c]) == len(k))
        out.append((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k],
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def awkward_rows():
    rng = random.Random(7)
    pool = [("user", "hello there"), ("assistant", "hi"), ("user", None), (None, "x y z"), ("", ""), ("user", " \t\n"), ("user", "é" * 3000 + " ok")]
    rows = []
    for c in [*range(-25, 70), 10**12, 10**12 + 7]:
        turns = [rng.choice(pool) for _ in range(rng.randint(1, 6))]
        rows += [(c, i if i else None, *t) for i, t in enumerate(turns)]
    rows += [(100, 1, "user", "tie b"), (100, 1, "user", "tie a"), (100, 1, "assistant", "tie"), (100, 2, "user", "end")]
    rows += [(101, 1, "user", "twice"), (101, 1, "user", "twice")]
    rows += [(None, 0, "user", "nobody's")]
    rows += [(c, i, "user", f"long {min(i, c % 6 + 5)}") for c in range(200, 212) for i in range(11)]  # over blocks of four
    rows += [(c, i, "user", f"same {i}") for c in range(300, 420) for i in range(3)]  # many copies
    rows += [(441, 0, "user", "gone")]  # its base is absent, so it may lose all its turns
    return rows


@pytest.mark.parametrize("nodes,share", [(65_536, 1_000), (0, 1), (40, 1), (10**9, 1)])
def test_trie_equals_brute_force(spark, monkeypatch, nodes, share):
    monkeypatch.setattr(prefix_trie, "BLOCK", 4)
    rows = awkward_rows()
    df = table(spark, rows).repartition(5)
    want = brute(rebuilt(conversations(rows)))
    assert got(prefix_trie.prefix_trie(df, tail_nodes=nodes, tail_share=share)) == want


def test_trie_unchanged_conversations(spark):
    rows = [r for r in awkward_rows() if r[0] is None or r[0] < 200]
    assert got(prefix_trie.prefix_trie(table(spark, rows), rebuild=prefix_trie.as_they_are)) == brute(conversations(rows))


def test_trie_hot_parents_and_chunks(spark, monkeypatch):
    rows = awkward_rows()
    monkeypatch.setattr(prefix_trie, "HOT_PARENTS", 5)
    monkeypatch.setattr(prefix_trie, "IDS_PER_CHUNK", 7)
    assert got(prefix_trie.prefix_trie(table(spark, rows))) == brute(rebuilt(conversations(rows)))


def test_trie_of_nothing(spark):
    assert got(prefix_trie.prefix_trie(table(spark, []))) == []
    lost = [c for c in range(1, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3][0]
    only = [(lost, 0, "user", "a b"), (None, 1, "user", "c")]
    assert got(prefix_trie.prefix_trie(table(spark, only))) == [
        (lost, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lost).encode()).hexdigest())]


def test_tail_start_bounds_its_turns():
    rng = random.Random(2)
    for _ in range(200):
        lengths = {rng.randint(0, 60): rng.randint(1, 500) for _ in range(rng.randint(1, 8))}
        nodes, share = rng.randint(0, 2000), rng.choice([1, 2, 10, 100])
        start = prefix_trie.tail_start(lengths, nodes, share)
        alive = {d: sum(n for x, n in lengths.items() if x >= d) for d in range(1, 62)}
        assert sum(a for d, a in alive.items() if d > start) <= max(nodes, 0)
        assert all(alive[d] * share <= sum(lengths.values()) for d in alive if d > start)
