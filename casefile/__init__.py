"""Analysis of tables of timestamped, optionally located records on Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that they need no
# copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
