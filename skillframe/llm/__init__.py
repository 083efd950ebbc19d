"""Operators for preparing training text. Nothing else in the package imports this folder.

Functions that run in Python workers are sent to them whole, so a cluster need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
