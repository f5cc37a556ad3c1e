"""Operators for preparing training text, and their queries.

Functions of this subpackage travel to Python workers by value, so that workers
need not find it on their own path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
