"""Pre-tokenizer and corpus splitting semantics."""

import regex
from pyspark.sql import functions as F

from pairforge.functions.expressions import pretokens, split_lines, split_on_specials
from pairforge.functions.patterns import PRETOKEN_PATTERN, java_class
from pairforge.operators.pretokenize import word_counts


def _one(spark, text, specials=()):
    df = spark.createDataFrame([(text,)], "text string")
    return list(df.select(pretokens("text", specials).alias("p")).first().p)


def test_matches_python_regex_on_edge_texts(spark):
    pat = regex.compile(PRETOKEN_PATTERN)
    samples = ["it's  a test\n\n x", "a \tb", "   x", "Hello world! This is a test.\nNew line here.",
               "número 42,5 €uro", "tabs\t\t\tend  ", "x  y", "ünïcödé's they'll we've",
               "", "   ", "a　　b", "emoji 😀😀 ok"]
    for s in samples:
        assert _one(spark, s) == pat.findall(s), s


def test_pretokens_concatenate_to_text(small_docs):
    bad = small_docs.where(F.array_join(pretokens("text", []), "") != F.col("text")).count()
    assert bad == 0


def test_specials_split_first_listed_wins(spark):
    text = "ab<|endoftext|>cd<|end|>ef"
    assert _one(spark, text, ["<|endoftext|>", "<|end"]) == ["ab", "cd", "|>", "ef"]
    assert _one(spark, text, ["<|end", "<|endoftext|>"]) == ["ab", "oftext", "|>", "cd", "|>", "ef"]


def test_special_split_dup_and_empty(spark):
    df = spark.createDataFrame([("a<|x|>b",)], "text string")
    assert list(df.select(split_on_specials("text", ["<|x|>", "<|x|>"])).first()[0]) == ["a", "b"]
    assert list(df.select(split_on_specials("text", [])).first()[0]) == ["a<|x|>b"]
    assert list(df.select(split_on_specials("text", [""])).first()[0]) == ["a<|x|>b"]


def test_special_with_regex_chars_and_backslash_e(spark):
    df = spark.createDataFrame([(r"a[\E]b",)], "text string")
    assert list(df.select(split_on_specials("text", [r"[\E]"])).first()[0]) == ["a", "b"]


def test_lines_keep_newlines(spark):
    df = spark.createDataFrame([("a\r\nb\rc\n\nd",)], "text string")
    assert list(df.select(split_lines("text")).first()[0]) == ["a\n", "b\n", "c\n", "\n", "d"]


def test_word_counts_partition_independent(spark, small_docs):
    a = {(r.word, r.n) for r in word_counts(small_docs.repartition(1)).collect()}
    b = {(r.word, r.n) for r in word_counts(small_docs.repartition(7)).collect()}
    assert a == b


def test_invalid_utf8_dropped(spark, tmpdir_run):
    from pairforge.sources.corpus import read_text_files
    p = f"{tmpdir_run}/bad.txt"
    with open(p, "wb") as f:
        f.write(b"ok \xff\xfe text \xc3\xa9")
    assert read_text_files(spark, p).first().text == "ok  text é"


def test_missing_input_reports_path(spark):
    import pytest
    from pairforge.sources.corpus import read_documents
    with pytest.raises(FileNotFoundError):
        read_documents(spark, "/nonexistent/docs.parquet")


def test_every_code_point_follows_the_newest_unicode_table(spark):
    """Each code point in the places where its class decides where pre-tokens end."""
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    texts = [f"a{chr(c)}a1{chr(c)}1 {chr(c)}.{chr(c)}. {chr(c)}'{chr(c)} " for c in points]
    step = 4096
    df = spark.createDataFrame([(i, " \n".join(texts[i:i + step])) for i in range(0, len(texts), step)], "i int, text string")
    pat = regex.compile(PRETOKEN_PATTERN)
    got = {r.i: list(r.p) for r in df.repartition(16).select("i", pretokens("text", []).alias("p")).collect()}
    bad = [i for i, p in got.items() if p != pat.findall(" \n".join(texts[i:i + step]))]
    assert len(got) == -(-len(texts) // step) and not bad, [hex(points[i]) for i in bad]


def test_tree_class_holds_exactly_its_ranges(spark):
    ranges = [(0x100 + 5 * i, 0x100 + 5 * i + i % 3) for i in range(100)]
    inside = {c for lo, hi in ranges for c in range(lo, hi + 1)}
    df = spark.range(0xF0, 0x320).select("id", F.expr(
        "decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')").alias("c"))
    got = {r.id for r in df.where(F.col("c").rlike(f"^[{java_class(ranges, 3)}]$")).collect()}
    assert got == inside
    got = {r.id for r in df.where(F.col("c").rlike(f"^[^a[{java_class(ranges, 3)}]]$")).collect()}
    assert got == set(range(0xF0, 0x320)) - inside
