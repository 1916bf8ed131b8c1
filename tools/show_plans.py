"""Print the physical plans of the main operators (the tree part of explain).

usage: python tools/show_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import io
import os
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from pairforge.operators.decode import decode  # noqa: E402
from pairforge.operators.encode import encode, token_counts  # noqa: E402
from pairforge.operators.offsets import token_offsets  # noqa: E402
from pairforge.operators.pairs import pair_counts  # noqa: E402
from pairforge.operators.pretokenize import training_words, word_counts  # noqa: E402
from pairforge.plans.queries import model_for  # noqa: E402
from pairforge.session import local_session  # noqa: E402


def tree(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    head = text.split("\n\n(1)")[0]
    scans = [ln for ln in text.splitlines() if ln.startswith(("ReadSchema", "PushedFilters"))]
    return head.strip() + "\n" + "\n".join(sorted(set(scans)))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    m = model_for(spark, sf)
    en = docs.where(F.col("lang") == "en")
    items = [
        ("word counts (A4) on lang='en': filter and column pruning reach the scan", word_counts(en)),
        ("one training round (A1 + O2): explode, partial/final aggregate, top K",
         pair_counts(training_words(word_counts(docs)), max_id=300).orderBy(F.desc("n")).limit(1024)),
        ("encode (E1): one projection per row",
         encode(spark, docs, m)),
        ("token totals without ids (E11)", token_counts(spark, docs, m, group=["lang"])),
        ("decode (E5): one projection, constant-folded table",
         decode(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.array(F.lit(1)).alias("ids")), m)),
        ("write offsets (W2): running sums inside ranges of a written copy",
         token_offsets(encode(spark, docs, m), order=["doc_id"])),
    ]
    print("# Physical plans (sf0.01, local[8], generated by tools/show_plans.py)\n")
    for title, df in items:
        print(f"## {title}\n\n```\n{tree(df)}\n```\n")


if __name__ == "__main__":
    main()
