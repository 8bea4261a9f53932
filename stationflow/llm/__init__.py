"""Operators for preparing training text.

Functions of this package travel to the executors by value, so a cluster needs
no copy of it beside the libraries of ``README.md``.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
