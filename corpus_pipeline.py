"""A training-data pipeline over ``documents``: quality, near-dedup, repeats, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that ``run`` writes as
Parquet in the shared checkpoint folder and reads again as the next stage's input, so
a lost executor never sends the job back past a stage.  All but the last return the
columns of ``documents`` as they came, extra ones included; a stage that changes
texts sets ``n_chars`` anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.llm import packing, quality, secret_scan, simhash, suffix_dedup
from pairforge.llm.common import spill_table, table

WORDS_PER_SHINGLE, MAX_DISTANCE = 4, 4  # of the SimHash operator's contract


def _with_n_chars(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood-ratio threshold."""
    rows = docs.select("doc_id", "text", F.struct("*").alias("__row"))
    judged = quality.judge(rows, quality.trusted_keys(table(spark, sf_dir, "labels")))
    return judged.where("kept").select("__row.*")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each class of linked fingerprints."""
    return simhash.keep_one(docs, words_per_shingle=WORDS_PER_SHINGLE, max_distance=MAX_DISTANCE)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without bytes covered by a 100-byte string that starts earlier in the corpus."""
    return _with_n_chars(suffix_dedup.remove_repeats(docs))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with each secret replaced by a mark."""
    return _with_n_chars(secret_scan.redact(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents, packed in sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

#: Fingerprints, tokens and packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = spill_table(docs, "pipeline-" + name.replace(" ", "-").lower())
    return docs
