"""Operators of a training-data pipeline over the tables documents, labels, benchmark and pages.

Functions that run in Python workers are sent with the task, so executors
need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
