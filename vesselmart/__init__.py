"""Vessel-movement warehouse and key functions on PySpark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python workers need not have the package installed: its functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
