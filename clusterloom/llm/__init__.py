"""Operators that prepare training data for language models.

Functions of this subpackage travel to executors by value, so that executors
need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
