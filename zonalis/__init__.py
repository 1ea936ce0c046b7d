"""Areal analytics on Spark: vote and census roll-ups, polygon overlay, interpolation and regression."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the query, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
