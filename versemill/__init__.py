"""versemill: text-classification analytics on PySpark DataFrames."""

import sys

from pyspark import cloudpickle

# The functions that run in tasks travel with them, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
