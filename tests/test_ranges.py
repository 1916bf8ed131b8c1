"""Byte-range scan of text with records of any size."""

import os
import random

import pytest
import regex
from pyspark.sql import functions as F

from pairforge.functions.patterns import PRETOKEN_PATTERN
from pairforge.operators.pretokenize import word_counts
from pairforge.sources.ranges import first_cut, read_text_ranges

SP = "<|endoftext|>"


def counts(pieces):
    from collections import Counter

    pattern = regex.compile(PRETOKEN_PATTERN)
    return Counter(w for p in pieces for w in pattern.findall(p))


def junk(rng, n, delimiter):
    parts = ["a", "word", " ", "  ", "\n", "\t", "é", "漢字", "　", " ", "'s", "42", ".", "\x1c", delimiter, delimiter[:3],
             "\x85", "\xa0", "😀"]
    out = b"".join(rng.choice(parts).encode() for _ in range(n))
    raw = bytearray(out)
    for _ in range(n // 20):  # invalid bytes anywhere, inside characters and delimiters too
        raw.insert(rng.randrange(len(raw)), rng.choice([0x80, 0xC0, 0xE2, 0xFF, 0xF0]))
    return bytes(raw)


@pytest.mark.parametrize("delimiter", [SP, "<| a b |>", "aa", "\n"])
def test_cuts_keep_pretokens_and_delimiters_whole(delimiter):
    rng = random.Random(5)
    for _ in range(60):
        raw = junk(rng, rng.randint(1, 300), delimiter)

        def read_at(n, at):
            return raw[at:at + n]

        cuts = sorted({first_cut(read_at, len(raw), at, delimiter.encode()) for at in range(len(raw) + 1)})
        pieces = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        assert b"".join(pieces) == raw
        split = [p for piece in pieces for p in piece.split(delimiter.encode())]
        want = [p.decode("utf-8", "ignore") for p in raw.split(delimiter.encode())]
        assert counts(p.decode("utf-8", "ignore") for p in split) == counts(want)
        assert sum(piece.count(delimiter.encode()) for piece in pieces) == raw.count(delimiter.encode())


def test_windows_do_not_change_a_cut():
    raw = b"x" * 200_000 + "漢".encode() * 50_000 + b" y" + b" " * 100_000 + b"z w"

    def read_at(n, at):
        return raw[at:at + n]

    blank = 350_000
    assert first_cut(read_at, len(raw), 1, b"") == blank
    assert first_cut(read_at, len(raw), blank, b"") == blank
    assert first_cut(read_at, len(raw), blank + 1, b"") == blank + 2
    assert first_cut(read_at, len(raw), blank + 3, b"") == len(raw) - 2
    assert first_cut(read_at, len(raw), len(raw) - 1, b"") == len(raw)


@pytest.mark.parametrize("delimiter", [SP, ""])
def test_one_large_record_runs_in_many_tasks_with_equal_counts(spark, tmpdir_run, delimiter):
    rng = random.Random(6)
    raw = junk(rng, 120_000, "|")
    path = os.path.join(tmpdir_run, "one.txt")
    with open(path, "wb") as f:
        f.write(raw)
    df = read_text_ranges(spark, path, delimiter, range_bytes=20_000, piece_bytes=3_000)
    tasks = df.select(F.spark_partition_id().alias("t")).groupBy("t").count().collect()
    assert len(tasks) > 10
    got = {r.word: r.n for r in word_counts(df.select("text"), "text", [SP]).collect()}
    assert got == dict(counts([raw.decode("utf-8", "ignore")]))
    rows = df.orderBy("pos").collect()
    assert [r.starts for r in rows] == [True] + [False] * (len(rows) - 1)
    assert "".join(r.text for r in rows) == raw.decode("utf-8", "ignore")
    assert max(len(r.text.encode()) for r in rows) < 10_000


def test_records_of_a_folder(spark, tmpdir_run):
    texts = ["first one", "", "a  b c", "漢字 é", " lead", "tail "]
    for i, last in enumerate([SP, ""]):
        with open(os.path.join(tmpdir_run, f"part-{i}.txt"), "wb") as f:
            f.write((SP.join(texts) + last).encode())
    for name in ("_SUCCESS", "empty.txt"):
        open(os.path.join(tmpdir_run, name), "w").close()
    for size in (1, 7, 1000):
        rows = read_text_ranges(spark, tmpdir_run, SP, range_bytes=size, piece_bytes=size).orderBy("path", "pos", F.desc("starts")).collect()
        for path in {r.path for r in rows}:
            records = []
            for r in rows:
                if r.path == path:
                    if r.starts:
                        records.append("")
                    records[-1] += r.text
            assert records == texts
    with pytest.raises(FileNotFoundError):
        read_text_ranges(spark, os.path.join(tmpdir_run, "none"))
