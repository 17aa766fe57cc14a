"""panelkit: Spark-native analytics for entity x period panels."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in Python workers are shipped with the task, so executors need no copy of
# this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
