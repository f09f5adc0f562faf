"""Operators for preparing training text; nothing else in the library imports this folder."""

import sys

from pyspark import cloudpickle

# Tasks get these functions with the job, so executors need no copy of the library on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
