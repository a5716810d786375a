"""Operators for large text corpora; nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
