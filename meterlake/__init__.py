"""Meter analytics as composable PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.2.0"

# Functions sent to Python workers carry their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
