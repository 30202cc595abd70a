"""Operators for preparing large text corpora. Nothing else in the library imports this subpackage.

What runs in a Python worker is sent by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
