"""Operators for preparing text corpora: dedup, quality, URL rules, similarity, language, pages, shards, packing.

Python code of the operators travels with each job, so executors need
no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
