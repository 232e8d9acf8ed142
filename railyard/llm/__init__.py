"""Operators of a training-data pipeline; nothing else in railyard imports this."""

import sys

from pyspark import cloudpickle

# Functions reach the tasks by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
