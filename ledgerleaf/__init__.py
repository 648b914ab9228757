"""Document analytics and revenue forecasting as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value: executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
