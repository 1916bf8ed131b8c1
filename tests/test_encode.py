"""Encoding / decoding and the corpus sinks."""

import glob
import os
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairforge.functions.expressions import split_lines
from pairforge.operators.decode import decode, roundtrip_violations, token_strings
from pairforge.operators.encode import encode, encode_texts, token_counts
from pairforge.plans.jobs import encode_splits
from pairforge.plans.train import TrainConfig, train


@pytest.fixture(scope="module")
def model(spark, small_docs):
    return train(spark, small_docs, TrainConfig(vocab_size=320))


def test_roundtrip_documents(spark, small_docs, model):
    enc = encode(spark, small_docs, model)
    assert roundtrip_violations(enc, small_docs, model).count() == 0
    assert enc.count() == small_docs.count()


def test_roundtrip_sample_with_newline(spark, model):
    x = "Hello world! This is a test.\nNew line here."
    ids = encode_texts(spark, model, [x])[0]
    df = spark.createDataFrame([(ids,)], "ids array<int>")
    assert decode(df, model).first().decoded == x
    assert "".join(token_strings("ids", model) is not None and df.select(token_strings("ids", model)).first()[0])


def test_specials_kept_and_skipped(spark, model):
    x = "one<|endoftext|>two<|endoftext|>"
    ids = encode_texts(spark, model, [x])[0]
    assert ids.count(256) == 2 and ids[-1] == 256
    df = spark.createDataFrame([(ids,)], "ids array<int>")
    assert decode(df, model, skip_special_tokens=True).first().decoded == "onetwo"
    assert decode(df, model).first().decoded == x


def test_encoding_equals_training_words(spark, small_docs, model):
    # the encoding of the training words equals their state after training
    from pairforge.functions.expressions import seq_to_ids
    from pairforge.operators.merges import merge_expr
    from pairforge.operators.pretokenize import training_words, word_counts
    w = training_words(word_counts(small_docs)).limit(3000)
    mine = w.select(F.decode(F.encode("seq", "ISO-8859-1"), "UTF-8").alias("word"),
                    seq_to_ids(merge_expr("seq", model.merges)).alias("ids"))
    from pairforge.operators.encode import encode_words
    enc = encode_words(spark, mine.select("word"), model).withColumnRenamed("ids", "ids2")
    assert mine.join(enc, "word").where(F.col("ids") != F.col("ids2")).count() == 0


def test_token_counts_match_encode(spark, small_docs, model):
    total = encode(spark, small_docs, model).agg(F.sum("n_tokens")).first()[0]
    assert token_counts(spark, small_docs, model).first().n_tokens == total


def joined_ids(spark, model, texts):
    """Ids of texts put together from the encodings of their distinct words (another way than the row UDF)."""
    from pairforge.functions.expressions import pretokens
    from pairforge.operators.encode import encode_words
    pieces = texts.select("doc_id", F.posexplode(pretokens("text")).alias("pos", "word"))
    known = encode_words(spark, pieces.select("word").distinct(), model)
    parts = pieces.join(known, "word").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("pos", "ids"))).alias("p"))
    return {r.doc_id: [i for x in r.p for i in x.ids] for r in parts.collect()}


def test_row_encoding_equals_word_by_word(spark, small_docs, model):
    got = {r.doc_id: r.ids for r in encode(spark, small_docs, model).collect()}
    assert got == joined_ids(spark, model, small_docs)


def test_specials_and_lines_are_encoded_in_order(spark, small_docs, model):
    src = small_docs.withColumn("text", F.replace("text", F.lit("\n"), F.lit("<|endoftext|>")))
    for r in encode(spark, src, model).join(src, "doc_id").select("ids", "text").collect():
        parts = r.text.split("<|endoftext|>")
        assert r.ids.count(256) == len(parts) - 1
    lines = encode(spark, small_docs, model, unit="line")
    whole = joined_ids(spark, model, lines.select((F.col("doc_id") * 1_000_000 + F.col("line_no")).alias("doc_id"), "ids")
                       .join(small_docs.select(F.posexplode(split_lines("text")).alias("line_no", "text"), "doc_id")
                             .select((F.col("doc_id") * 1_000_000 + F.col("line_no")).alias("doc_id"), "text"), "doc_id"))
    got = {r.doc_id * 1_000_000 + r.line_no: r.ids for r in lines.collect()}
    assert got == whole


def test_rows_that_share_a_key_stay_apart(spark, model):
    df = spark.createDataFrame([(1, "the cat"), (1, "a hat"), (None, "the cat")], "doc_id long, text string")
    alone = encode_texts(spark, model, ["the cat", "a hat"])
    got = sorted((r.doc_id is None, r.ids) for r in encode(spark, df, model).collect())
    assert got == sorted([(False, alone[0]), (False, alone[1]), (True, alone[0])])


def test_empty_and_null_texts_count_nothing(spark, model):
    df = spark.createDataFrame([(1, "", "en"), (2, None, "de"), (3, "a", "fr")], "doc_id long, text string, lang string")
    assert {r.lang: r.n_tokens for r in token_counts(spark, df, model, group=["lang"]).collect()} == {"en": 0, "de": 0, "fr": 1}
    assert {r.doc_id: r.ids for r in encode(spark, df, model).collect()} == {1: [], 2: [], 3: [97]}
    none = df.limit(0)
    assert encode(spark, none, model).count() == 0 and token_counts(spark, none, model).first().n_tokens == 0


def test_many_specials_in_one_row(spark, model):
    n = 20_000
    df = spark.createDataFrame([(1, "a<|endoftext|>" * n)], "doc_id long, text string")
    assert encode(spark, df, model).first().ids == [97, 256] * n


def test_unknown_token_of_any_name(spark):
    docs = spark.createDataFrame([(1, "ab ab ab")], "doc_id long, text string")
    m = train(spark, docs, TrainConfig(vocab_size=262, initial_alphabet="observed", unk_token="[UNK]"))
    unk = m.special_ids()["[UNK]"]
    assert encode_texts(spark, m, ["abz"])[0][-1] == unk
    bare = train(spark, docs, TrainConfig(vocab_size=262, initial_alphabet="observed"))
    with pytest.raises(Exception, match="no unknown token"):
        encode_texts(spark, bare, ["abz"])


def test_long_words_equal_the_plain_procedure():
    import random

    from pairforge.functions.udfs import bpe_ids, bpe_ids_long
    rng = random.Random(5)
    table, new = {}, 4
    for rank in range(12):
        pair = (rng.randrange(new), rng.randrange(new))
        if pair not in table:
            table[pair] = (rank, new)
            new += 1
    for _ in range(500):
        ids = [rng.randrange(4) for _ in range(rng.randint(0, 60))]
        assert bpe_ids_long(list(ids), table) == bpe_ids(list(ids), table)


def test_offsets_with_null_keys_and_string_order(spark):
    from pairforge.operators.offsets import token_offsets
    rows = [(s, k, n) for s in ("a", None, "b") for k in ("x", "y", None, "zz", "y") for n in (3, 0, 5)]
    df = spark.createDataFrame(rows, "split string, name string, n_tokens long")
    for buckets in (1, 4, 40):
        out = token_offsets(df, order=["name", "n_tokens"], partition=["split"], buckets=buckets).collect()
        assert len(out) == len(rows)
        for s in ("a", None, "b"):
            mine = sorted((r for r in out if r.split == s), key=lambda r: (r.start_pos, r.n_tokens))
            at = 0
            for r in mine:
                assert r.start_pos == at
                at += r.n_tokens
            names = [r.name for r in sorted(mine, key=lambda r: r.start_pos) if r.n_tokens]
            assert names == sorted(names, key=lambda x: (x is not None, x or ""))


def test_shards_overwrite_and_read_back(spark, small_docs, model, tmpdir_run):
    from pairforge.sources.shards import read_token_shards, write_token_shards
    toks = encode_splits(spark, {"train": small_docs, "val": small_docs.where("doc_id < 9")}, model, unit="line")
    path = f"{tmpdir_run}/bin"
    write_token_shards(toks, path, shards=7)
    write_token_shards(toks, path, shards=3)
    assert len(glob.glob(f"{path}/*/*.bin")) <= 4 and not glob.glob(f"{path}/_temporary*")
    want = toks.select("split", F.posexplode("ids").alias("i", "id"), "start_pos").selectExpr("split", "start_pos + i AS pos", "id")
    got = read_token_shards(spark, path)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    with pytest.raises(Exception, match="append would replace"):
        write_token_shards(toks, path, shards=3, mode="append")


def test_lines_and_offsets(spark, small_docs, model):
    toks = encode_splits(spark, {"train": small_docs}, model, unit="line")
    rows = toks.orderBy("doc_id", "line_no").collect()
    pos = 0
    for r in rows:
        assert r.start_pos == pos
        pos += r.n_tokens


def test_shards_roundtrip_and_range_check(spark, small_docs, model, tmpdir_run):
    from pairforge.sources.shards import check_uint16, write_token_shards
    toks = encode_splits(spark, {"train": small_docs.where("doc_id % 10 != 0"),
                                 "val": small_docs.where("doc_id % 10 = 0")}, model, unit="line")
    write_token_shards(toks, f"{tmpdir_run}/bin", order=("doc_id", "line_no"), shards=5)
    for split in ("train", "val"):
        arr = np.concatenate([np.fromfile(f, "<u2") for f in sorted(glob.glob(f"{tmpdir_run}/bin/{split}/*.bin"))])
        ref = [i for r in toks.where(F.col("split") == split).orderBy("doc_id", "line_no").collect() for i in r.ids]
        assert arr.tolist() == ref
    big = spark.createDataFrame([("train", 0, [70000])], "split string, start_pos bigint, ids array<int>")
    with pytest.raises(ValueError):
        check_uint16(big)


def test_stream_stop_restart_equals_batch(spark, small_docs, model, tmpdir_run):
    from pairforge.streaming.encode_stream import document_stream, start_stream_encode, stream_totals
    src = f"{tmpdir_run}/src"
    small_docs.where("doc_id % 2 = 0").write.parquet(f"{src}/part=a")
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    st = lambda: document_stream(spark, f"{src}/part=a", schema)
    start_stream_encode(st(), model, f"{tmpdir_run}/out", f"{tmpdir_run}/ck").awaitTermination()
    small_docs.where("doc_id % 2 = 1").write.mode("append").parquet(f"{src}/part=a")
    start_stream_encode(st(), model, f"{tmpdir_run}/out", f"{tmpdir_run}/ck").awaitTermination()
    got = spark.read.parquet(f"{tmpdir_run}/out")
    assert got.select("batch_id").distinct().count() == 2
    ref = encode(spark, small_docs, model, unit="line", skip_empty=True)
    a = {(r.doc_id, r.line_no, tuple(r.ids)) for r in got.collect()}
    b = {(r.doc_id, r.line_no, tuple(r.ids)) for r in ref.collect()}
    assert a == b
    assert stream_totals(spark, f"{tmpdir_run}/out").first().n_tokens == sum(len(x[2]) for x in b)


def test_bundle_and_text_roundtrip(spark, model, tmpdir_run):
    from pairforge.sources.bundle import load_model, model_from_text, save_model, write_merges_text, write_vocab_json
    save_model(spark, model, f"{tmpdir_run}/b")
    m2 = load_model(spark, f"{tmpdir_run}/b")
    assert (m2.vocab, m2.merges, m2.special_tokens) == (model.vocab, model.merges, model.special_tokens)
    write_merges_text(model.merges_df(spark), f"{tmpdir_run}/m")
    write_vocab_json(model.vocab_df(spark), f"{tmpdir_run}/v")
    m3 = model_from_text(spark, f"{tmpdir_run}/v", f"{tmpdir_run}/m", ["<|endoftext|>"])
    assert m3.vocab == model.vocab and m3.merges == model.merges


def test_merges_of_several_files_keep_their_order(spark, tmpdir_run):
    import os

    from pairforge.sources.bundle import read_merges_text
    os.makedirs(f"{tmpdir_run}/m")
    for name, lines in (("part-0", "a b\n\nb c\n"), ("part-1", "c " + "d" * 5000 + "\n" + "e f\n")):
        with open(f"{tmpdir_run}/m/{name}", "w") as f:
            f.write(lines)
    rows = read_merges_text(spark, f"{tmpdir_run}/m").orderBy("rank").collect()
    assert [bytes(r.left_bytes) for r in rows] == [b"a", b"b", b"c", b"e"]


def test_vocab_json_of_duplicate_specials(spark):
    import json

    from pairforge.operators.vocab import initial_vocab, vocab_frame
    from pairforge.sources.bundle import vocab_json
    v, k = initial_vocab(["<s>", "<s>"])
    got = json.loads(vocab_json(vocab_frame(spark, v, k)).first().value)
    assert got["<s>"] == 256 and len(got) == 257


def test_offsets_of_nan_zero_and_nested_streams(spark):
    nan, n = float("nan"), 25_000
    rows = spark.range(n).select("id", F.lit(2).alias("n_tokens"), F.when(F.col("id") % 3 == 0, F.lit(nan)).when(F.col("id") % 3 == 1, F.lit(0.0)).otherwise(F.lit(-0.0)).alias("k"))
    from pairforge.operators.offsets import token_offsets
    got = token_offsets(rows, order=["id"], partition=["k"], buckets=5)
    assert set(got.columns) == {"id", "n_tokens", "k", "start_pos"}
    per = {r.nan: (r.n, r.top) for r in got.groupBy(F.isnan("k").alias("nan")).agg(F.countDistinct("start_pos").alias("n"), F.max("start_pos").alias("top")).collect()}
    k = (n + 2) // 3
    assert per == {True: (k, 2 * (k - 1)), False: (n - k, 2 * (n - k - 1))}
    nested = token_offsets(rows.withColumn("k", F.struct("k")), order=["id"], partition=["k"], buckets=5)
    assert nested.where(F.isnan("k.k")).agg(F.countDistinct("start_pos")).first()[0] == k


def test_decode_ignore_equals_python(spark):
    import random
    from pairforge.sources.corpus import decode_utf8_ignore
    rng = random.Random(5)
    pieces = [b"a", b"\xc3\xa9", b"\xe2\x82\xac", b"\xf0\x9f\x98\x80", b"\x80", b"\xff", b"\xc0", b"\xed\xa0\x80", b"\xf4\x90", b"\xe2\x82", b"\xf0\x9f", b"\x00", b"\n"]
    rows = [b"".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(1500)] + [bytes(rng.choices(range(256), k=200)) for _ in range(300)]
    rows += [b"\xff" + "é€😀x".encode() * 20_000, b""]
    df = spark.createDataFrame([(i, bytearray(r)) for i, r in enumerate(rows)], "i int, b binary").select("i", decode_utf8_ignore("b").alias("t"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    assert {r.i: r.t for r in df.collect()} == {i: r.decode("utf-8", "ignore") for i, r in enumerate(rows)}


def test_spreading_does_not_run_the_plan(spark):
    from pairforge.session import ensure_parallel
    grouped = spark.range(100).repartition(3).groupBy((F.col("id") % 5).alias("k")).count()
    spark.sparkContext.setJobGroup("spread", "spread")
    ensure_parallel(grouped, spark)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("spread")) == []
    assert ensure_parallel(spark.range(10).coalesce(1), spark).rdd.getNumPartitions() > 1


def _read_back(path):
    import glob
    out = {}
    for f in sorted(glob.glob(f"{path}/*/shard-*.bin")):
        split, at = f.split("/")[-2], int(f[-24:-4])
        data = open(f, "rb").read()
        assert at == len(out.get(split, b"")) // 2, f
        out[split] = out.get(split, b"") + data
    return out


def test_token_stream_equals_batch_after_stops_replays_and_half_commits(spark, tmpdir_run):
    import json
    import os
    import struct
    from pairforge.sources.shards import next_positions, qualified, read_token_shards, start_token_stream
    src, out, ck = f"{tmpdir_run}/in", f"{tmpdir_run}/out", f"{tmpdir_run}/ck"
    rows = [(i, "val" if i % 4 == 0 else "train", [i, i + 1, 65535][: i % 4]) for i in range(90)]
    schema = "i INT, split STRING, ids ARRAY<INT>"

    def more(part):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)

    def run():
        st = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        start_token_stream(st, out, ck).awaitTermination()

    def want(part):
        got = {}
        for _, split, ids in part:
            if ids:
                got[split] = got.get(split, b"") + struct.pack(f"<{len(ids)}H", *ids)
        return got

    more(rows[:30])
    run()
    run()  # nothing new
    assert _read_back(out) == want(rows[:30])
    more(rows[30:60])
    run()
    assert _read_back(out) == want(rows[:60])
    # the driver died after it placed an epoch's files, before its manifest: the epoch is replayed
    last = sorted(os.listdir(f"{out}/_epochs"))[-1]
    os.remove(f"{out}/_epochs/{last}")
    commits = sorted((c for c in os.listdir(f"{ck}/commits") if c.isdigit()), key=int)
    for c in commits[-1:]:
        os.remove(f"{ck}/commits/{c}")
        if os.path.exists(f"{ck}/commits/.{c}.crc"):
            os.remove(f"{ck}/commits/.{c}.crc")
    open(f"{out}/train/shard-{999:020d}.bin", "wb").write(b"xx")  # of a task that the replay does not have
    run()
    assert _read_back(out) == want(rows[:60])
    more(rows[60:])
    run()
    assert _read_back(out) == want(rows)
    assert not [x for x in os.listdir(out) if x.startswith("_temporary")]
    full = want(rows)
    assert next_positions(qualified(spark, out)) == {s: len(b) // 2 for s, b in full.items()}
    assert json.load(open(f"{out}/_epochs/{last}"))["epoch"] == int(last[:-5])
    part = read_token_shards(spark, out, split="train", begin=7, end=31)
    assert [(r.pos, r.id) for r in part.orderBy("pos").collect()] == list(enumerate(struct.unpack("<24H", full["train"][14:62]), 7))


def test_range_reader_opens_only_the_range(spark, tmpdir_run, monkeypatch):
    from pairforge.sources import shards
    toks = spark.range(1000).selectExpr("CASE WHEN id < 600 THEN 'a' ELSE 'b' END AS split", "CASE WHEN id < 600 THEN id ELSE id - 600 END * 3 AS start_pos",
                                        "array(1, 2, cast(id AS int)) AS ids")
    path = f"{tmpdir_run}/bin"
    shards.write_token_shards(toks, path, shards=6)
    uri = shards.qualified(spark, path)
    monkeypatch.setattr(shards, "RANGE_TOKENS", 100)
    parts = shards.TokenShardReader({"path": uri, "split": "a", "begin": "250", "end": "700"}).partitions()
    assert sum(p.end - p.begin for p in parts) == 450 and {p.split for p in parts} == {"a"} and len(parts) >= 5
    assert sum(b.num_rows for p in parts for b in shards.TokenShardReader({"path": uri}).read(p)) == 450
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        found = shards.read_token_shards(spark, path).where("split = 'b' AND pos >= 10 AND pos < 16 AND id > 1").collect()
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    assert sorted((r.pos, r.id) for r in found) == [(p, x) for p, x in ((p, (1, 2, 600 + p // 3)[p % 3]) for p in range(10, 16)) if x > 1]
    reader = shards.FilteredShardReader({"path": uri})
    from pyspark.sql.datasource import EqualTo, GreaterThan, LessThanOrEqual
    rest = list(reader.pushFilters([EqualTo(("split",), "b"), GreaterThan(("pos",), 9), LessThanOrEqual(("pos",), 20), EqualTo(("id",), 1)]))
    assert rest == [EqualTo(("id",), 1)] and sum(p.end - p.begin for p in reader.partitions()) == 11


def test_compacted_word_counts(spark, tmpdir_run):
    import os
    from pairforge.streaming.encode_stream import compact_word_counts, latest_word_counts, start_word_counts
    src, out, ck = f"{tmpdir_run}/in", f"{tmpdir_run}/out", f"{tmpdir_run}/ck"
    texts = ["a b", "b c", "a a", "d", "b"]
    for i, t in enumerate(texts):
        spark.createDataFrame([(i, t)], "doc_id long, text string").coalesce(1).write.mode("append").parquet(src)
    st = spark.readStream.schema("doc_id long, text string").option("maxFilesPerTrigger", 1).parquet(src)
    start_word_counts(st, out, ck, compact_every=2).awaitTermination()
    want = {"a": 2, " b": 1, "b": 2, " c": 1, " a": 1, "d": 1}
    assert {r.word: r.n for r in latest_word_counts(spark, out).collect()} == want
    assert sorted(x for x in os.listdir(out) if x.startswith("batch_id")) == ["batch_id=4"]
    compact_word_counts(spark, out, 4)
    compact_word_counts(spark, out, 4)
    assert {r.word: r.n for r in latest_word_counts(spark, out).collect()} == want
    assert not [x for x in os.listdir(out) if x.startswith("batch_id")]


def test_stream_queries_take_a_table_of_one_file_or_of_several(spark, tmpdir_run):
    """documents.parquet may be a file or a folder of files."""
    from pairforge.plans.queries import QUERIES

    rows = [(i, f"red {i % 3} blue\nred", "en", "s", 10) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    df.repartition(4).write.parquet(f"{tmpdir_run}/folder/documents.parquet")
    df.coalesce(1).write.parquet(f"{tmpdir_run}/one")
    os.makedirs(f"{tmpdir_run}/file")
    part = next(f for f in os.listdir(f"{tmpdir_run}/one") if f.endswith(".parquet"))
    shutil.copy(f"{tmpdir_run}/one/{part}", f"{tmpdir_run}/file/documents.parquet")
    for kind in ("folder", "file"):
        words = dict(tuple(r) for r in QUERIES["stream_word_counts"](spark, f"{tmpdir_run}/{kind}").collect())
        assert (words["red"], words[" blue"], sum(words.values())) == (80, 40, 200)
        totals = QUERIES["stream_encode_totals"](spark, f"{tmpdir_run}/{kind}").collect()
        assert sorted(r["doc_id"] for r in totals) == list(range(40))


def test_words_at_once_equal_one_by_one():
    """the words of a slice are encoded together; no table of words is kept."""
    import random

    import pyarrow as pa

    from pairforge.functions.udfs import ids_of_words, word_ids

    rng = random.Random(5)
    words = ["", "a", "aaa", "aaaa", "aaaaa" * 30, "é", "ab" * 32, "ba" * 33]
    words += ["".join(rng.choice("aabcé") for _ in range(rng.randint(0, 70))) for _ in range(3000)]
    for case in range(20):
        table, known = {}, [97, 98, 99, 0xC3, 0xA9]
        for rank in range(rng.randint(0, 25)):
            pair = (rng.choice(known), rng.choice(known))
            if pair not in table:
                table[pair] = (rank, 300 + rank)
                known.append(300 + rank)
        some = {b: 1000 + b for b in range(256) if b != 99} if case % 5 == 4 else None
        ids, sizes = ids_of_words(pa.array(["skipped", *words]).slice(1), table, some, 7 if some else None)
        want = [word_ids(w, table, some, 7 if some else None) for w in words]
        assert sizes.tolist() == [len(x) for x in want]
        assert ids.tolist() == [i for x in want for i in x]
    with pytest.raises(ValueError, match="alphabet"):
        ids_of_words(pa.array(["c"]), {}, {97: 97})


def test_a_batch_is_encoded_in_bounded_slices(spark, model, monkeypatch):
    """what a worker holds at a time follows the slice, not the batch."""
    import pyarrow as pa

    from pairforge.functions import udfs
    from pairforge.operators.encode import _encoder_parts

    seen = []
    plain = udfs.ids_of_words
    monkeypatch.setattr(udfs, "SLICE_ITEMS", 50)
    monkeypatch.setattr(udfs, "ids_of_words", lambda words, *a: seen.append(len(words)) or plain(words, *a))
    sp = "<|endoftext|>"
    rows = [[[f" w{i}", "ab", "aa"], [f"{i}"]] for i in range(200)] + [[[]], [[], [], []], [[f" {i}" for i in range(300)]]]
    found = [[sp] * (len(r) - 1) for r in rows]
    for counts in (False, True):
        udf = udfs.make_row_udf(*_encoder_parts(spark, model), model.special_ids(), counts)
        got = udf.func(pa.array(rows, pa.list_(pa.list_(pa.string()))), pa.array(found, pa.list_(pa.string())))
        table, special = {(a, b): (r, n) for r, (a, b, n) in enumerate(model.merges)}, model.special_ids()[sp]
        want = []
        for r in rows:
            ids = [[i for w in s for i in udfs.word_ids(w, table)] for s in r]
            want.append(sum(([special, *s] for s in ids[1:]), ids[0]))
        assert got.to_pylist() == ([len(w) for w in want] if counts else want)
    assert len(seen) > 20 and max(seen) <= 300


def test_offsets_take_only_counts_and_keys_through_python(spark, model, small_docs):
    """ids stay in Spark while rows are placed."""
    from unittest import mock

    from pairforge.operators import offsets

    plans = []
    spill = offsets.spill_table

    def kept(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return spill(df, name)

    enc = encode(spark, small_docs.limit(50), model)
    with mock.patch.object(offsets, "spill_table", kept):
        out = offsets.token_offsets(enc, order=["doc_id"]).orderBy("doc_id").collect()
    plan = dict(plans)["offset-ranges"]
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan
    assert [r["start_pos"] for r in out] == list(np.cumsum([0] + [r["n_tokens"] for r in out])[:-1])


def test_shards_in_runs_need_no_shuffle_and_any_order_is_right(spark, tmpdir_run):
    """each contiguous run becomes a shard where it is; broken runs give more files, not wrong ones."""
    from pairforge.sources.shards import read_token_shards, shard_listing, write_token_shards

    rows = [(s, 3 * i, [i % 7, i, 5]) for s in ("a", "b") for i in range(30)]
    want = sorted((s, p + k, x) for s, p, ids in rows for k, x in enumerate(ids))
    for name, given in (("ordered", rows), ("mixed", [rows[(7 * i) % 60] for i in range(60)])):
        path = f"{tmpdir_run}/{name}"
        df = spark.createDataFrame(given, "split STRING, start_pos BIGINT, ids ARRAY<INT>").coalesce(1)
        write_token_shards(df, path, in_runs=True)
        assert sorted(map(tuple, read_token_shards(spark, path).collect())) == want
        assert (shard_listing(spark, path).count() == 2) == (name == "ordered")


def test_document_batches_are_bounded_and_in_order(spark, tmpdir_run):
    """As many files as the text asks for, each a range of doc_id, dated in that order."""
    from pairforge.plans import queries

    rows = [(i * 7 % 400, "x" * 100) for i in range(400)]
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING").write.parquet(f"{tmpdir_run}/documents.parquet")
    for size, least in ((1 << 30, 3), (5000, 8)):
        got = []
        stream = queries._document_batches(spark, tmpdir_run, batch_bytes=size)
        w = stream.writeStream.foreachBatch(lambda df, i: got.append([r["doc_id"] for r in df.collect()]))  # noqa: B023
        w.option("checkpointLocation", f"{tmpdir_run}/ck{size}").trigger(availableNow=True).start().awaitTermination()
        assert len(got) >= least and [i for b in got for i in b] == list(range(400))
        assert size > 5000 or max(map(len, got)) <= 100


def test_text_files_follow_the_input(spark, tmpdir_run):
    """the corpus files are as many as the tasks that read the table, not four."""
    from unittest import mock

    from pairforge.plans import queries
    from pairforge.sources import corpus

    rows = [(i, f"low lower lowest {i}") for i in range(300)]
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(12).write.parquet(f"{tmpdir_run}/documents.parquet")
    read, seen = corpus.read_text_records, []
    with mock.patch.object(corpus, "read_text_records", lambda s, path, *a: seen.append(len(glob.glob(f"{path.removeprefix('file:')}/part-*"))) or read(s, path, *a)):
        merges = queries.QUERIES["train_merges_16_text_files"](spark, tmpdir_run).collect()
    want = queries.QUERIES["train_merges_16"](spark, tmpdir_run).collect()
    assert seen[0] > 4 and merges == want


def test_texts_are_dealt_before_they_are_encoded(spark, model, tmpdir_run):
    """no ids are shuffled, and they are written once; rows of one key keep the order of their lines."""
    from unittest import mock

    from pairforge.operators import offsets

    rows = [(i % 40 if i % 7 else None, f"the {i % 40} low\r\nlower" + " lowest" * (i % 5) + "\n" * (i % 3)) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(5)
    plans, spill = [], offsets.spill_table

    def kept(df, name, **kind):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        assert dict(df.dtypes)["ids"] == "binary"  # packed, one value a row
        return spill(df, name, **kind)

    with mock.patch.object(offsets, "spill_table", kept):
        toks = encode_splits(spark, {"a": docs, "b": docs.where("doc_id < 9")}, model, unit="line")
        got = toks.orderBy("split", "start_pos").collect()
    assert [name for name, _ in plans] == ["offset-ranges"]
    assert plans[0][1].rindex("ArrowEvalPython") < plans[0][1].index("rangepartitioning")  # the plan begins with its last step
    lines = [(s, k, n, x) for s in "ab" for k, t in rows if s == "a" or (k is not None and k < 9)
             for n, x in enumerate(t.replace("\r\n", "\n").splitlines(keepends=True))]
    ids = encode_texts(spark, model, [x for *_, x in lines])
    key = lambda r: (r[0], r[1] is not None, r[1] or 0, r[2])
    assert [key(r) for r in got] == sorted(map(key, lines))
    assert sorted((key(r), list(r.ids)) for r in got) == sorted((key(r), i) for r, i in zip(lines, ids))
    for s in "ab":
        of = [r for r in got if r.split == s]
        assert [r.start_pos for r in of] == list(np.cumsum([0] + [r.n_tokens for r in of])[:-1])


def test_shards_are_read_in_blocks(spark, tmpdir_run, monkeypatch):
    """ids leave Python in arrays that generated code explodes, cut at any place."""
    from pairforge.sources import shards

    toks = spark.range(300).selectExpr("CASE WHEN id < 200 THEN 'a' ELSE 'b' END AS split", "CASE WHEN id < 200 THEN id ELSE id - 200 END * 3 AS start_pos",
                                       "array(1, 65535, cast(id AS int)) AS ids")
    path = f"{tmpdir_run}/bin"
    shards.write_token_shards(toks, path, shards=3)
    monkeypatch.setattr(shards, "RANGE_TOKENS", 101)
    monkeypatch.setattr(shards, "READ_TOKENS", 17)
    monkeypatch.setattr(shards, "BLOCK_TOKENS", 5)
    want = sorted(("a" if i < 200 else "b", 3 * (i if i < 200 else i - 200) + k, x) for i in range(300) for k, x in enumerate((1, 65535, i)))
    df = shards.read_token_shards(spark, path)
    assert "posexplode" in df._jdf.queryExecution().executedPlan().toString()
    assert df.dtypes == [("split", "string"), ("pos", "bigint"), ("id", "int")] and sorted(map(tuple, df.collect())) == want
    part = shards.read_token_shards(spark, path, split="a", begin=250, end=472)
    assert sorted(map(tuple, part.collect())) == [r for r in want if r[0] == "a" and 250 <= r[1] < 472]
    parts = shards.TokenBlockReader({"path": shards.qualified(spark, path)}).partitions()
    blocks = [b for p in parts for b in shards.TokenBlockReader({"path": shards.qualified(spark, path)}).read(p)]
    assert max(len(i) for b in blocks for i in b.column("ids").to_pylist()) == 5 and sum(len(b.column("ids").flatten()) for b in blocks) == 900


def test_packed_ids_come_back(spark, model):
    """ids of any size, empty rows and slices of a batch."""
    import pyarrow as pa
    from pairforge.functions.udfs import make_unpack_udf, packed_type
    from pairforge.operators.encode import unpack_ids

    assert [packed_type(v) for v in ({}, {65535: b""}, {65536: b""})] == ["<u2", "<u2", "<i4"]
    rows = [[1, 65535], [], [7], [0, 256, 3]]
    for kind, more in (("<u2", 0), ("<i4", 70000)):
        raw = pa.array([np.array([i + more for i in r], kind).tobytes() for r in rows])
        unpack = make_unpack_udf(kind).func
        assert unpack(raw).to_pylist() == [[i + more for i in r] for r in rows]
        assert unpack(raw.slice(1, 2)).to_pylist() == [[], [7 + more]] and unpack(raw.slice(1, 1)).to_pylist() == [[]]
        assert unpack(raw.slice(0, 0)).to_pylist() == []
    docs = spark.createDataFrame([(1, "low lower"), (2, ""), (3, None), (4, "x<|endoftext|>\n")], "doc_id BIGINT, text STRING")
    got = encode(spark, docs, model, packed=True).withColumn("ids", unpack_ids(model)).orderBy("doc_id").collect()
    assert got == encode(spark, docs, model).orderBy("doc_id").collect()
