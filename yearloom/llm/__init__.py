"""Training-data operators: each module holds one operator; queries.py binds them to the test tables.

Nothing outside this package imports it.  Functions that run in Python tasks are shipped by value, so executors do not
need the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
