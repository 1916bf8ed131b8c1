"""Small tables with the awkward cases every operator must take."""

import random

SYL = "the an er on re ti en in at es or he nd ed ou".split()


def prose(rng, n):
    return " ".join("".join(rng.choices(SYL, k=rng.randint(1, 3))) for _ in range(n))


def awkward(seed=1):
    """(doc_id, text): nulls, empty, white space, one word, long, copies, near copies, repeated rows, ties."""
    rng = random.Random(seed)
    a, b, c = prose(rng, 120), prose(rng, 90), prose(rng, 70)
    near = a.split()
    near[60] = "changed"
    long = "\n".join(prose(rng, 40) for _ in range(300))
    shared = prose(rng, 60)
    return [
        (1, a), (2, b), (3, None), (4, ""), (5, " \t\n\x0b\f\r "), (6, "one"), (7, a), (8, " ".join(near)), (9, long),
        (10, b + " " + shared + " " + c), (11, c[:200] + shared + "\n" + prose(rng, 20)), (12, "é" * 400 + "漢字😀 " * 60),
        (12, "é" * 400 + "漢字😀 " * 60), (13, "x" * 1000), (14, "ab" * 300 + "é"), (15, "two words"), (16, "<p>a &amp; b</p>"),
        (17, long + "!"), (18, "a\x00b 　 c▁d"), (None, "a null key " + shared), (-4, shared),
    ]


def frame(spark, rows, clash=False):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if clash:  # columns named like those that operators add
        names = ("kept", "n_words", "llr", "fp", "component", "k", "h", "piece", "length", "spans", "chunk", "keys",
                 "offsets", "data", "rest", "size", "shard", "slot", "host", "path", "block", "member", "b", "key", "label")
        df = df.selectExpr("*", *[f"concat('{n}', doc_id) AS {n}" for n in names])
    return df


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")
