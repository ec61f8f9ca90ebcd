"""Time-series analytics and forecasting on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel by value: a cluster needs no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
