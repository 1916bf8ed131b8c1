"""Operators of a training-data pipeline; see ``queries.py`` for the registered ones.

Worker code is pickled by value, as in the rest of the library, so executors
need no installed copy of this package.
"""

from pyspark import cloudpickle as _cloudpickle

from pairforge.llm import (
    chunks,
    common,
    embed_dedup,
    graph,
    hard_negatives,
    html_extract,
    packing,
    pii,
    prefix_trie,
    quality,
    secret_scan,
    sentencepiece_codec,
    sharding,
    simhash,
    suffix_dedup,
    url_filter,
)

for _m in (chunks, common, embed_dedup, graph, hard_negatives, html_extract, packing, pii, prefix_trie, quality, secret_scan, sentencepiece_codec, sharding, simhash, suffix_dedup, url_filter):
    _cloudpickle.register_pickle_by_value(_m)
