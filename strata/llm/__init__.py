"""Operators for training-data pipelines; nothing else in the library imports them.

The functions that run inside Spark's Python workers are pickled by value, so executors
need no copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
