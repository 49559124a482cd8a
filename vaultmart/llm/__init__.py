"""Operators for preparing language-model training data.

One module per operator; ``queries`` holds the registered queries and their
DuckDB statements.  Nothing outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so a cluster
# needs no copy of it on the executors' import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
