"""Event-stream processing on Spark DataFrames.

A destination is a table of envelopes; every operator takes and returns DataFrames and, unless
its docstring says "batch", works on streaming frames unchanged.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
