"""Operators for training-data pipelines.  Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package that run in Python workers travel by value, so no
# executor needs the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
