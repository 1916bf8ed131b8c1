"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

All read the driver tables in full.  Training-based queries use a 16-merge
model (vocab 273 = 256 bytes + 1 special + 16 merges) so that DuckDB can
check them with unrolled SQL; larger trainings are registered without SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairforge.functions.expressions import seq_from_word
from pairforge.functions.patterns import DEFAULT_SPECIAL_TOKEN
from pairforge.operators.compare import merges_diff, vocab_set_diff
from pairforge.operators.decode import decode
from pairforge.operators.encode import encode, token_counts
from pairforge.operators.merges import delta_counts, merge_expr, update_counts
from pairforge.operators.offsets import token_offsets
from pairforge.operators.pairs import (
    accumulate_counts,
    pair_counts,
    pair_index,
    top_pairs,
    with_ids,
)
from pairforge.operators.pretokenize import (
    byte_histogram,
    pretokens_per_document,
    training_words,
    word_counts,
)
from pairforge.operators.stats import token_total
from pairforge.operators.vocab import (
    initial_vocab,
    longest_token,
    to_alphabet,
    vocab_frame,
    vocab_size,
)
from pairforge.plans.jobs import encode_splits, split_totals
from pairforge.plans.train import TrainConfig, train
from pairforge.session import ensure_parallel, spill_table
from pairforge.sources.corpus import line_counts, read_table, split_documents

SP = DEFAULT_SPECIAL_TOKEN
SECOND_SPECIAL = "<|end"
ORACLE_MERGES = 16

def docs(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents")


def model_for(spark: SparkSession, d: str, lang: str | None = None, merges: int = ORACLE_MERGES,
              count_mode: str = "frontier"):
    src = docs(spark, d)
    if lang is not None:
        src = src.where(F.col("lang") == lang)
    return train(spark, src, TrainConfig(vocab_size=257 + merges, count_mode=count_mode))


def _words(spark, d):
    return word_counts(docs(spark, d), "text", [SP])


def _initial_vocab_df(spark):
    v, k = initial_vocab([SP])
    return vocab_frame(spark, v, k)


def _with_specials(df: DataFrame) -> DataFrame:
    return df.withColumn("text", F.replace("text", F.lit("\n"), F.lit(SP)))


# -- pre-tokens ----------------------------------------------------------------

def q_pretoken_counts(spark, d):
    return _words(spark, d)


def q_pretoken_counts_by_lang(spark, d):
    return word_counts(docs(spark, d), "text", [SP], group=["lang"])


def q_pretokens_per_document(spark, d):
    return pretokens_per_document(docs(spark, d), "doc_id", "text", [SP])


def q_pretoken_alphabet(spark, d):
    w = _words(spark, d)
    return w.select("word", to_alphabet(F.encode("word", "UTF-8")).alias("display"), "n")


def q_pretoken_counts_conversations(spark, d):
    conv = read_table(spark, d, "conversations")
    return word_counts(conv, "text", [SP], group=["role"])


def q_pretoken_counts_pages(spark, d):
    pages = read_table(spark, d, "pages")
    return word_counts(pages, "html", [SP])


def q_split_on_special(spark, d):
    return split_documents(_with_specials(docs(spark, d)), "text", [SP], keep=["doc_id"])


def q_split_on_special_list(spark, d):
    src = _with_specials(docs(spark, d)).withColumn(
        "text", F.replace("text", F.lit(", "), F.lit(SECOND_SPECIAL)))
    return split_documents(src, "text", [SP, SECOND_SPECIAL], keep=["doc_id"])


def q_byte_histogram(spark, d):
    return byte_histogram(_words(spark, d))


def q_line_counts(spark, d):
    return line_counts(docs(spark, d))


# -- pairs ---------------------------------------------------------------------

def _pairs(spark, d, where=None):
    src = docs(spark, d)
    if where is not None:
        src = src.where(where)
    return pair_counts(training_words(word_counts(src, "text", [SP])))


def q_pair_counts(spark, d):
    return with_ids(_pairs(spark, d)).select("left", "right", "n")


def q_pair_counts_accumulated(spark, d):
    en = _pairs(spark, d, F.col("lang") == "en")
    rest = _pairs(spark, d, ~(F.col("lang") == "en") | F.col("lang").isNull())
    return with_ids(accumulate_counts(en, rest)).select("left", "right", "n")


def q_pair_index_size(spark, d):
    w = training_words(_words(spark, d)).withColumn("word_id", F.xxhash64("seq"))
    idx = pair_index(w, "word_id")
    return with_ids(idx.groupBy("pair").agg(F.count(F.lit(1)).alias("n_words"))).select(
        "left", "right", "n_words")


def q_top_pairs_20(spark, d):
    top = top_pairs(_pairs(spark, d), _initial_vocab_df(spark), 20)
    w = Window.orderBy(F.desc("n"), F.desc("left_bytes"), F.desc("right_bytes"), "left", "right")
    return top.select((F.row_number().over(w) - 1).cast("int").alias("rank"),
                      F.hex("left_bytes").alias("left_hex"), F.hex("right_bytes").alias("right_hex"), "n")


def _first_merge(spark, d):
    best = top_pairs(_pairs(spark, d), _initial_vocab_df(spark), 1).collect()[0]
    return (int(best["left"]), int(best["right"]), 257)


def q_merge_once(spark, d):
    m = _first_merge(spark, d)
    w = _words(spark, d)
    return w.select("word", F.length(merge_expr(seq_from_word("word"), [m])).cast("int").alias("n_tokens"))


def q_affected_words(spark, d):
    from pairforge.operators.merges import affected_words
    m = _first_merge(spark, d)
    w = _words(spark, d).withColumn("seq", seq_from_word("word"))
    return affected_words(w, [m]).select("word", "n")


def q_pair_counts_after_merge_delta(spark, d):
    m = _first_merge(spark, d)
    words = training_words(_words(spark, d))
    counts = update_counts(pair_counts(words), delta_counts(words, [m]))
    v, k = initial_vocab([SP])
    v[257] = v[m[0]] + v[m[1]]
    vocab = vocab_frame(spark, v, k)
    lv = vocab.select(F.col("id").alias("left"), F.hex("bytes").alias("left_hex"))
    rv = vocab.select(F.col("id").alias("right"), F.hex("bytes").alias("right_hex"))
    return (with_ids(counts).join(F.broadcast(lv), "left").join(F.broadcast(rv), "right")
            .select("left_hex", "right_hex", "n"))


# -- training ------------------------------------------------------------------

def q_train_merges_16(spark, d):
    m = model_for(spark, d)
    return m.merges_df(spark).select("rank", F.hex("left_bytes").alias("left_hex"),
                                     F.hex("right_bytes").alias("right_hex"))


def q_train_merges_16_delta(spark, d):
    m = model_for(spark, d, count_mode="delta")
    return m.merges_df(spark).select("rank", F.hex("left_bytes").alias("left_hex"),
                                     F.hex("right_bytes").alias("right_hex"))


def q_train_vocab_16(spark, d):
    return model_for(spark, d).vocab_df(spark).select("id", F.hex("bytes").alias("hex"), "kind")


def q_longest_token(spark, d):
    return longest_token(model_for(spark, d).vocab_df(spark))


def q_vocab_size(spark, d):
    return vocab_size(model_for(spark, d).vocab_df(spark))


def q_merges_text(spark, d):
    m = model_for(spark, d).merges_df(spark)
    return m.select("rank", F.concat_ws(" ", to_alphabet("left_bytes"), to_alphabet("right_bytes")).alias("line"))


def q_merges_diff_by_lang(spark, d):
    a = model_for(spark, d, "en").merges_df(spark)
    b = model_for(spark, d, "fr").merges_df(spark)
    return merges_diff(a, b)


def q_vocab_set_difference(spark, d):
    a = model_for(spark, d, "en").vocab_df(spark)
    b = model_for(spark, d, "fr").vocab_df(spark)
    return vocab_set_diff(a, b)


def q_train_merges_64(spark, d):
    m = model_for(spark, d, merges=64)
    return m.merges_df(spark).select("rank", F.hex("left_bytes").alias("left_hex"),
                                     F.hex("right_bytes").alias("right_hex"))


def _merges(spark, model):
    return model.merges_df(spark).select("rank", F.hex("left_bytes").alias("left_hex"), F.hex("right_bytes").alias("right_hex"))


def q_train_merges_64_delta(spark, d):
    """Counts kept as a bucketed log of signed changes (M3)."""
    return _merges(spark, model_for(spark, d, merges=64, count_mode="delta"))


def q_train_merges_64_index(spark, d):
    """Pieces of words found through the maintained inverted index (Jn2, A2, P10)."""
    return _merges(spark, model_for(spark, d, merges=64, count_mode="index"))


def q_train_report_64(spark, d):
    """Run report of a training (S16) without its times."""
    import time

    from pairforge.operators.stats import train_report
    from pairforge.plans.train import train_words

    start = time.time()
    words = spill_table(_words(spark, d), "report-words")
    totals = words.agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("pretokens")).first()
    model = train_words(spark, training_words(words), TrainConfig(vocab_size=257 + 64))
    report = train_report(spark, model, time.time() - start, totals["words"], totals["pretokens"])
    return report.select("vocab_size", "merges", (F.col("recounts") < F.col("rounds")).alias("fewer_recounts"), "longest_id",
                         "longest_bytes", "longest_hex", "distinct_words", "pretokens")


def q_train_merges_1000(spark, d):
    """Larger training (vocab 1000); no SQL oracle (checked by pytest)."""
    m = model_for(spark, d, merges=1000 - 257)
    return m.merges_df(spark).select("rank", F.hex("left_bytes").alias("left_hex"),
                                     F.hex("right_bytes").alias("right_hex"))


# -- encode / decode -----------------------------------------------------------

def _ids_text(df):
    return df.withColumn("ids_text", F.array_join("ids", " ")).drop("ids")


def q_encode_documents_16(spark, d):
    return _ids_text(encode(spark, docs(spark, d), model_for(spark, d)))


def q_encode_lines_16(spark, d):
    return _ids_text(encode(spark, docs(spark, d), model_for(spark, d), unit="line"))


def q_token_totals_by_lang(spark, d):
    return token_counts(spark, docs(spark, d), model_for(spark, d), group=["lang"])


def q_token_total_weighted(spark, d):
    return token_counts(spark, docs(spark, d), model_for(spark, d))


def q_token_totals_by_role(spark, d):
    conv = read_table(spark, d, "conversations")
    return token_counts(spark, conv, model_for(spark, d), group=["role"])


def q_token_total_benchmark(spark, d):
    bench = read_table(spark, d, "benchmark")
    return token_counts(spark, bench, model_for(spark, d))


def q_token_offsets(spark, d):
    src = docs(spark, d)
    enc = encode(spark, src, model_for(spark, d))
    return token_offsets(enc, order=["doc_id"]).select("doc_id", "n_tokens", "start_pos")


def q_split_token_totals(spark, d):
    src = docs(spark, d)
    val = src.where(F.col("doc_id") % 10 == 0)
    train_ = src.where(~(F.col("doc_id") % 10 == 0))
    toks = encode_splits(spark, {"train": train_, "val": val}, model_for(spark, d), unit="line")
    return split_totals(toks)


def q_decode_roundtrip(spark, d):
    m = model_for(spark, d)
    enc = encode(spark, docs(spark, d), m)
    return decode(enc, m, "ids", "text").select("doc_id", "text")


def q_decode_skip_specials(spark, d):
    m = model_for(spark, d)
    enc = encode(spark, _with_specials(docs(spark, d)), m)
    return decode(enc, m, "ids", "text", skip_special_tokens=True).select("doc_id", "text")


def q_token_total_by_split_rows(spark, d):
    enc = encode(spark, docs(spark, d), model_for(spark, d))
    return token_total(enc.withColumn("split", F.when(F.col("doc_id") % 10 == 0, "val").otherwise("train")),
                       group=["split"])


def q_encode_conversations_16(spark, d):
    """Rows that share their key (several turns of one conversation) are encoded one by one."""
    return _ids_text(encode(spark, read_table(spark, d, "conversations"), model_for(spark, d), key=["conv_id"]))


def q_token_counts_blank_texts(spark, d):
    """Empty and null texts count nothing."""
    m = F.col("doc_id") % 10
    src = docs(spark, d).withColumn("text", F.when(m == 0, F.lit(None)).when(m == 1, F.lit("")).otherwise(F.col("text")))
    return token_counts(spark, src.withColumn("m", m), model_for(spark, d), group=["m"])


def q_encode_many_specials(spark, d):
    """A special token for each blank: up to thousands in a row."""
    src = docs(spark, d).withColumn("text", F.replace("text", F.lit(" "), F.lit(SP)))
    return encode(spark, src, model_for(spark, d)).select("doc_id", "n_tokens")


def q_token_strings_16(spark, d):
    from pairforge.operators.decode import token_strings
    m = model_for(spark, d)
    enc = encode(spark, docs(spark, d), m)
    return enc.select("doc_id", F.array_join(token_strings("ids", m), " ").alias("tokens"))


def q_token_offsets_by_lang(spark, d):
    """Null stream keys and a string order key."""
    src = docs(spark, d).withColumn("stream", F.when(F.col("lang") != "de", F.col("lang")))
    enc = encode(spark, src, model_for(spark, d), key=["stream", "source", "doc_id"])
    return token_offsets(enc, order=["source", "doc_id"], partition=["stream"]).select(
        "stream", "source", "doc_id", "n_tokens", "start_pos")


# -- sinks, bundles, streams (each reads back what it wrote) ---------------------

DOC_SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def _merges_hex(mdf):
    return mdf.select("rank", F.hex("left_bytes").alias("left_hex"), F.hex("right_bytes").alias("right_hex"))


def q_bundle_merges_roundtrip(spark, d):
    from pairforge.sources.bundle import load_model, save_model
    from pairforge.session import scratch_path
    path = scratch_path(spark, "bundle")
    save_model(spark, model_for(spark, d), path)
    return _merges_hex(load_model(spark, path).merges_df(spark))


def q_text_export_roundtrip(spark, d):
    from pairforge.sources.bundle import model_from_text, write_merges_text, write_vocab_json
    from pairforge.session import scratch_path
    m = model_for(spark, d)
    base = scratch_path(spark, "text-export")
    write_merges_text(m.merges_df(spark), f"{base}/merges")
    write_vocab_json(m.vocab_df(spark), f"{base}/vocab")
    back = model_from_text(spark, f"{base}/vocab", f"{base}/merges", [SP])
    return _merges_hex(back.merges_df(spark))


def q_token_shards_totals(spark, d):
    from pairforge.sources.shards import shard_listing, write_token_shards
    from pairforge.session import scratch_path
    src = docs(spark, d)
    toks = encode_splits(spark, {"train": src.where(~(F.col("doc_id") % 10 == 0)),
                                 "val": src.where(F.col("doc_id") % 10 == 0)}, model_for(spark, d), unit="line")
    path = scratch_path(spark, "shards")
    write_token_shards(toks, path, order=("doc_id", "line_no"), in_runs=True)
    return shard_listing(spark, path).groupBy("split").agg(F.sum("n_tokens").cast("bigint").alias("n_tokens"))


def q_token_shards_ids(spark, d):
    """Every id of the written shards with its place in the stream."""
    from pairforge.sources.shards import read_token_shards, write_token_shards
    from pairforge.session import scratch_path
    src = docs(spark, d)
    toks = encode_splits(spark, {"train": src.where(~(F.col("doc_id") % 10 == 0)),
                                 "val": src.where(F.col("doc_id") % 10 == 0)}, model_for(spark, d), unit="line")
    path = scratch_path(spark, "shards")
    write_token_shards(toks, path, in_runs=True)
    return read_token_shards(spark, path)


BATCH_BYTES = 256 << 20   # text in one batch of a document stream
BATCH_GROUP_BYTES = 8 << 20  # row groups of its file, so that many tasks read it


def _document_batches(spark, d, n: int = 3, batch_bytes: int = BATCH_BYTES):
    """The documents as files in order of doc_id that a stream takes one at a time.

    There are ``n`` files, and more where one would hold over ``batch_bytes``; a task writes one, all at once.
    Documents without an id have no place in that order and are left out.
    """
    from pairforge.session import scratch_path
    from pairforge.streaming.encode_stream import document_stream
    src = docs(spark, d).select("doc_id", "text").where(F.col("doc_id").isNotNull())
    path = scratch_path(spark, "stream-in")
    total = src.agg(F.sum(F.octet_length("text") + F.lit(16))).first()[0] or 0
    n = max(n, -(-total // batch_bytes))
    (src.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id").write
     .option("parquet.block.size", BATCH_GROUP_BYTES).parquet(path))
    _date_in_order(spark, path)
    return document_stream(spark, path, "doc_id BIGINT, text STRING", max_files_per_trigger=1)


def _date_in_order(spark, path: str) -> None:
    """Date the files by name, as tasks end in any order; a stream takes older ones first."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted((f.getPath().getName(), f.getPath(), f.getModificationTime()) for f in fs.listStatus(folder)
                   if f.getPath().getName().endswith(".parquet"))
    start = min((t for _, _, t in files), default=0) - 1000 * len(files)
    for i, (_, file, _) in enumerate(files):
        fs.setTimes(file, start + 1000 * i, -1)


def q_decode_invalid_utf8(spark, d):
    """Texts cut to bytes in the middle of characters and with foreign bytes between, decoded ignoring errors."""
    from pairforge.sources.corpus import decode_utf8_ignore
    raw = F.encode("text", "UTF-8")
    junk = F.concat(F.unhex(F.lit("80C0E28228FF")), F.substring(raw, 2, 1 << 30), F.unhex(F.lit("F09F98")))
    return docs(spark, d).where(F.col("text").isNotNull() & (F.length("text") > 0)).select(
        "doc_id", decode_utf8_ignore(junk).alias("text"))


def q_stream_word_counts_compacted(spark, d):
    """Word counts of a stream whose batches are folded into a snapshot every second batch (T5)."""
    from pairforge.session import scratch_path
    from pairforge.streaming.encode_stream import latest_word_counts, start_word_counts
    out, ck = scratch_path(spark, "stream-words"), scratch_path(spark, "stream-ckpt")
    start_word_counts(_document_batches(spark, d), out, ck, compact_every=2).awaitTermination()
    return latest_word_counts(spark, out)


def _split_of():
    return F.when(F.col("doc_id") % 10 == 0, "val").otherwise("train")


def q_stream_shard_ids(spark, d):
    """Ids and positions of shards that a stream wrote in several epochs, stopped and started again between them."""
    from pairforge.session import scratch_path
    from pairforge.sources.shards import read_token_shards
    from pairforge.streaming.encode_stream import start_shard_encode
    path, ck = scratch_path(spark, "stream-shards"), scratch_path(spark, "stream-ckpt")
    model, stream = model_for(spark, d), _document_batches(spark, d)
    for _ in range(2):  # the second start finds nothing new
        start_shard_encode(stream, model, path, ck, _split_of()).awaitTermination()
    return read_token_shards(spark, path)


def q_stream_split_totals(spark, d):
    """Running totals per split from stream state."""
    from pairforge.session import scratch_path
    from pairforge.streaming.encode_stream import latest_totals, start_stream_totals
    out, ck = scratch_path(spark, "stream-totals"), scratch_path(spark, "stream-ckpt")
    start_stream_totals(_document_batches(spark, d), model_for(spark, d), out, ck, _split_of()).awaitTermination()
    return latest_totals(spark, out).select("split", "n_tokens", "n_rows")


def q_token_shards_range(spark, d):
    """A position range of one split: the reader opens only its bytes."""
    from pairforge.session import scratch_path
    from pairforge.sources.shards import read_token_shards, write_token_shards
    src = docs(spark, d)
    toks = encode_splits(spark, {"train": src.where(~(F.col("doc_id") % 10 == 0)),
                                 "val": src.where(F.col("doc_id") % 10 == 0)}, model_for(spark, d), unit="line")
    path = scratch_path(spark, "shards")
    write_token_shards(toks, path, in_runs=True)
    return read_token_shards(spark, path, split="val", begin=1_000, end=61_000)


def _documents_path(d: str) -> str:
    """The documents as one file or, in larger tables, as a folder of files."""
    return f"{d.rstrip('/')}/documents.parquet"


def q_stream_encode_totals(spark, d):
    from pairforge.session import scratch_path
    from pairforge.streaming.encode_stream import document_stream, start_stream_encode
    out, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    st = document_stream(spark, _documents_path(d), DOC_SCHEMA)
    start_stream_encode(st, model_for(spark, d), out, ck).awaitTermination()
    return (spark.read.parquet(out).groupBy("doc_id")
            .agg(F.sum("n_tokens").cast("bigint").alias("n_tokens")))


def q_stream_word_counts(spark, d):
    from pairforge.session import scratch_path
    from pairforge.streaming.encode_stream import document_stream, latest_word_counts, start_word_counts
    out, ck = scratch_path(spark, "wc-out"), scratch_path(spark, "wc-ckpt")
    st = document_stream(spark, _documents_path(d), DOC_SCHEMA)
    start_word_counts(st, out, ck).awaitTermination()
    return latest_word_counts(spark, out).select("word", F.col("n").cast("bigint").alias("n"))


def q_train_merges_16_text_files(spark, d):
    """Documents written as special-delimited text files, scanned back
    with delimiter-aligned splits (several files), then trained."""
    from pairforge.session import scratch_path
    from pairforge.sources.corpus import read_text_records
    path = scratch_path(spark, "corpus-text")
    ensure_parallel(docs(spark, d).select("text")).write.option("lineSep", SP).text(path)
    src = read_text_records(spark, path, SP)
    m = train(spark, src, TrainConfig(vocab_size=257 + ORACLE_MERGES))
    return m.merges_df(spark).select("rank", F.hex("left_bytes").alias("left_hex"),
                                     F.hex("right_bytes").alias("right_hex"))


def q_pretoken_counts_text_ranges(spark, d):
    """Documents written as delimited text, read in byte ranges far smaller than many records, counted."""
    from pairforge.session import scratch_path
    from pairforge.sources.ranges import read_text_ranges
    path = scratch_path(spark, "corpus-ranges")
    docs(spark, d).select("text").write.option("lineSep", SP).text(path)
    return word_counts(read_text_ranges(spark, path, SP, range_bytes=1 << 20, piece_bytes=1 << 10), "text", [SP])


QUERIES = {
    "pretoken_counts": q_pretoken_counts,
    "pretoken_counts_by_lang": q_pretoken_counts_by_lang,
    "pretoken_counts_conversations": q_pretoken_counts_conversations,
    "pretoken_counts_pages": q_pretoken_counts_pages,
    "pretokens_per_document": q_pretokens_per_document,
    "pretoken_alphabet": q_pretoken_alphabet,
    "split_on_special": q_split_on_special,
    "split_on_special_list": q_split_on_special_list,
    "byte_histogram": q_byte_histogram,
    "line_counts": q_line_counts,
    "pair_counts": q_pair_counts,
    "pair_counts_accumulated": q_pair_counts_accumulated,
    "pair_index_size": q_pair_index_size,
    "top_pairs_20": q_top_pairs_20,
    "merge_once": q_merge_once,
    "affected_words": q_affected_words,
    "pair_counts_after_merge_delta": q_pair_counts_after_merge_delta,
    "train_merges_16": q_train_merges_16,
    "train_merges_16_delta": q_train_merges_16_delta,
    "train_vocab_16": q_train_vocab_16,
    "longest_token": q_longest_token,
    "vocab_size": q_vocab_size,
    "merges_text": q_merges_text,
    "merges_diff_by_lang": q_merges_diff_by_lang,
    "vocab_set_difference": q_vocab_set_difference,
    "encode_documents_16": q_encode_documents_16,
    "encode_lines_16": q_encode_lines_16,
    "token_totals_by_lang": q_token_totals_by_lang,
    "token_total_weighted": q_token_total_weighted,
    "token_totals_by_role": q_token_totals_by_role,
    "token_total_benchmark": q_token_total_benchmark,
    "token_offsets": q_token_offsets,
    "split_token_totals": q_split_token_totals,
    "token_total_by_split_rows": q_token_total_by_split_rows,
    "decode_roundtrip": q_decode_roundtrip,
    "decode_skip_specials": q_decode_skip_specials,
    "train_merges_64": q_train_merges_64,
    "train_merges_64_delta": q_train_merges_64_delta,
    "train_merges_64_index": q_train_merges_64_index,
    "train_report_64": q_train_report_64,
    "train_merges_1000": q_train_merges_1000,
    "encode_conversations_16": q_encode_conversations_16,
    "token_counts_blank_texts": q_token_counts_blank_texts,
    "encode_many_specials": q_encode_many_specials,
    "token_strings_16": q_token_strings_16,
    "token_offsets_by_lang": q_token_offsets_by_lang,
    "token_shards_ids": q_token_shards_ids,
    "train_merges_16_text_files": q_train_merges_16_text_files,
    "pretoken_counts_text_ranges": q_pretoken_counts_text_ranges,
    "bundle_merges_roundtrip": q_bundle_merges_roundtrip,
    "text_export_roundtrip": q_text_export_roundtrip,
    "token_shards_totals": q_token_shards_totals,
    "token_shards_range": q_token_shards_range,
    "decode_invalid_utf8": q_decode_invalid_utf8,
    "stream_word_counts_compacted": q_stream_word_counts_compacted,
    "stream_shard_ids": q_stream_shard_ids,
    "stream_split_totals": q_stream_split_totals,
    "stream_encode_totals": q_stream_encode_totals,
    "stream_word_counts": q_stream_word_counts,
}
