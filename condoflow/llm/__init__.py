"""Operators for preparing training text; nothing else in the library imports this folder."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value, so executors need no copy of this folder on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
