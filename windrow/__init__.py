"""Windrow: everyday data work on tables and streams, written as plain Spark jobs."""

from pyspark import cloudpickle

# Functions of this package travel to Python workers by value, so a cluster needs no
# copy of the package on its executors.
import windrow as _package

cloudpickle.register_pickle_by_value(_package)
