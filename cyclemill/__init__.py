"""cyclemill: run-to-failure analytics for fleets of machines, on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# the numeric kernels travel to the executors with each job, so no copy need be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
