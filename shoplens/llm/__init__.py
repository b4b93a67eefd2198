"""Operators of a training-data pipeline: language ID, source mixing, license
scans, SentencePiece encoding, SimHash near-dedup, quality rules, WARC files,
line dedup, secret scans and document fingerprints. Nothing else in the
library imports this subpackage."""

import sys

from pyspark import cloudpickle

# The functions that run in Python workers travel with their tasks: executors
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
