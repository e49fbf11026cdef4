"""Spark-native document-corpus engine."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel whole, so that workers need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
