"""faultline: error-pattern analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle as _cloudpickle

from .session import get_spark, scratch_path, shared_dir

# Functions of this package that run inside Python workers (the batch
# function given to mapInPandas, its wrapper) are shipped by value, so
# executors need no copy of the package on their path.
_cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["get_spark", "scratch_path", "shared_dir"]
