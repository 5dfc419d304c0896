"""Operators for building training data from documents, and the queries that apply them.

Functions that run in Python workers travel with their job by value, so workers need
numpy and pyarrow but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
