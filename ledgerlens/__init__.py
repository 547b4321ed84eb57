"""Spark-native analytics over large transaction tables."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# executors need not have this package on their path: its functions travel with the tasks
register_pickle_by_value(sys.modules[__name__])
