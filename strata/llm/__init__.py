"""Operators of a training-data pipeline. Nothing else in the library imports them.

Functions of this subpackage travel to the executors by value, so a cluster
needs no copy of it on the workers' import path.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
