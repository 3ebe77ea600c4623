"""Operators for large training-text collections, each usable on its own.

Nothing else in the library imports this subpackage. Its functions travel to the executors by value, so a
cluster needs the library on the driver only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
