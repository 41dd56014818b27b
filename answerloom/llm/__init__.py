"""Operators of a training-data pipeline; each module states its method, its parameters and what it does with odd rows."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so the workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
