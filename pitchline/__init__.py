"""Football analytics as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel inside the task, so executors need no
# copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
