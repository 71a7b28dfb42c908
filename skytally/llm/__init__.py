"""Operators for preparing training data, and the queries that apply them.

Functions that run in Python workers travel with the job, so executors need numpy, pyarrow and xxhash but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
