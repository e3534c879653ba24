"""Operators of a training-data pipeline, one module per operator.

Nothing outside this package imports it. Functions that run in Python workers
are shipped by value, so executors need no path to the package.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
