"""Operators for training data: sharding, filtering, deduplication, packing, archives.

Nothing else in the library imports this package. Its functions travel to Python
workers by value, so that executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
