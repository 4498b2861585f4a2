"""postlens: text mining and topic discovery over forum posts, as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job; executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
