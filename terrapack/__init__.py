"""Spark-native engine that turns raw geographic sources into vector tile packs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers by value, so that executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
