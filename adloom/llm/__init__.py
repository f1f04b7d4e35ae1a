"""Operators for building training data from text; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors by value: workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
