"""cedarloom: open-data lakehouse, search and data-preparation operators on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions for Python workers travel whole: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
