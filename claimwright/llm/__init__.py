import sys

from pyspark import cloudpickle

# Functions of this package travel with their tasks, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
