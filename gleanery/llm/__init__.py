"""Operators of a training-data pipeline; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Python workers get the functions of this package with the task, and need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
