"""Operators of a training-data pipeline: deduplication, search, extraction, scoring, mixing.

Nothing outside this package imports it. Functions that run in Python workers are
shipped by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
