"""Analytics over yearly editions of an almanac, written as Spark DataFrames.

Functions that run in Python tasks are shipped by value, so executors do not need the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
