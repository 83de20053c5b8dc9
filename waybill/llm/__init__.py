"""Operators for training-data pipelines.  Nothing else in the library imports them.

Python workers get this package's functions by value, so it need not be on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
