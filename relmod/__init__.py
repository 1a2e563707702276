"""relmod: query expansion and re-ranking on Spark."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that run inside Python workers are shipped by value with the task,
# so executors need no installed copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
