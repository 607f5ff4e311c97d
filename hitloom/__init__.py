"""Spark-native operators on alignment hits, coverage, taxonomies and cohorts."""

import sys

from pyspark import cloudpickle

# Functions of the package travel to the executors by value, so a cluster needs no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
