"""Headline benchmark: prints one JSON line.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]``:
word counting (pre-tokenize + compact), BPE training to ``$BENCH_VOCAB``
(default 1000), line-level encoding with write offsets, the uint16 shard write,
and a decode round trip.  Extra fields report pre-tokens/s, rounds, seconds
per round, merges per round and encoded tokens/s.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    vocab = int(os.environ.get("BENCH_VOCAB", "1000"))
    from pyspark.sql import functions as F

    from pairforge.operators.decode import roundtrip_violations
    from pairforge.operators.encode import encode
    from pairforge.operators.pretokenize import training_words, word_counts
    from pairforge.plans.jobs import encode_splits
    from pairforge.plans.train import TrainConfig, train_words
    from pairforge.session import local_session, scratch_path
    from pairforge.sources.corpus import read_table
    from pairforge.sources.shards import write_token_shards

    default_parts = max(8, int(cpus)) if str(cpus).isdigit() else 8
    spark = local_session(cpus, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", default_parts)), "pairforge-bench")
    spark.sparkContext.setLogLevel("ERROR")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    q: dict[str, float] = {}

    t = time.time()
    wc = word_counts(docs).persist()
    stats = wc.agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("pretokens")).first()
    q["word_count"] = time.time() - t

    t = time.time()
    model = train_words(spark, training_words(wc), TrainConfig(
        vocab_size=vocab, speculate=int(os.environ.get("BENCH_SPECULATE", "0")),
        count_mode=os.environ.get("BENCH_COUNT_MODE", "frontier")))
    q["train"] = time.time() - t

    t = time.time()
    splits = {"train": docs.where(~(F.col("doc_id") % 10 == 0)), "val": docs.where(F.col("doc_id") % 10 == 0)}
    toks = encode_splits(spark, splits, model, unit="line").persist()
    n_tokens = toks.agg(F.sum("n_tokens")).first()[0]
    q["encode_lines"] = time.time() - t

    t = time.time()
    write_token_shards(toks, scratch_path(spark, "bench-shards"), order=("doc_id", "line_no"))
    q["write_shards"] = time.time() - t

    t = time.time()
    enc = encode(spark, docs, model)
    bad = roundtrip_violations(enc, docs, model).count()
    q["decode_roundtrip"] = time.time() - t

    rounds = len(model.rounds)
    recounts = sum(r.recount for r in model.rounds)
    total = sum(q.values())
    print(json.dumps({
        "metric": "bpe_train_encode_total", "value": round(total, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in q.items()}, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "vocab_size": vocab, "merges": len(model.merges), "rounds": rounds, "recounts": recounts,
        "seconds_per_round": round(q["train"] / rounds, 3) if rounds else None,
        "merges_per_round": round(len(model.merges) / rounds, 2) if rounds else None,
        "distinct_words": int(stats["words"]), "pretokens": int(stats["pretokens"]),
        "pretokens_per_sec": round(stats["pretokens"] / q["word_count"], 1),
        "encoded_tokens": int(n_tokens), "encoded_tokens_per_sec": round(n_tokens / q["encode_lines"], 1),
        "roundtrip_violations": bad, "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
