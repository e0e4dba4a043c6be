"""Account-activity analytics on Spark DataFrames: events in, marts, lookups and statistics out."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
