"""Spark-native analytics engine for hierarchical cell indices and geocoder builds.

Functions of this package that run in Python workers are pickled by value, so
executors do not need the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
