"""Cloud billing analytics on Spark: DataFrames in, DataFrames out."""

import sys

from pyspark import cloudpickle

# The few functions that run inside tasks travel with them, so that executors need no copy of
# this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
