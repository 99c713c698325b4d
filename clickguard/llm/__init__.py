"""Operators of a training-data pipeline, one module each, beside the
click-fraud engine. Nothing outside this subpackage imports it.

Functions that run in Python workers are pickled by value, so the workers
need numpy, pandas, pyarrow and xxhash but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
