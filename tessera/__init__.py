"""tessera: a PySpark-native engine for asset-report analytics.

Operators are functions from DataFrames to DataFrames; Catalyst plans them.
Python kernels are shipped to executors by value, so a cluster needs only the
public libraries (numpy, pyarrow, pandas) on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
