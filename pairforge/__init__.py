"""pairforge: byte-level BPE training and corpus tokenization on Spark."""

from pyspark import cloudpickle as _cloudpickle

from pairforge.functions import udfs as _udfs
from pairforge.sources import corpus as _corpus
from pairforge.sources import ranges as _ranges
from pairforge.sources import shards as _shards

# Code that runs inside Python workers is pickled by value, so executors
# need no installed copy of this package (nothing to ship with --py-files).
for _m in (_udfs, _corpus, _ranges, _shards):
    _cloudpickle.register_pickle_by_value(_m)
