"""Operators for large training-data pipelines."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job, so executors need not have it
# installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
