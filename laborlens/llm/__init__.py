"""Operators of a training-data pipeline; nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# The code of this folder travels with each task, so executors need no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
