"""plinth: document, figure and table extraction as lazy Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors by value, so a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
