"""Operators for preparing training data: deduplication, filtering, sharding, tokenizing.

Nothing else in the library imports this package. Its functions travel to the executors by
value, so workers need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
