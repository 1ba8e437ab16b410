"""Operators for building training data. Nothing else in the library imports this subpackage.

Functions that run inside tasks are sent to the executors by value, so executors need numpy and
pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
