"""Operators for preparing training text.  Nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so tasks do
# not need the repository on the executors' own module path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
