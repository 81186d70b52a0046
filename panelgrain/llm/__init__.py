"""Operators for training-data pipelines over tables of documents.

Every operator takes DataFrames with at least the columns it names, reads nothing else
of them, and returns a DataFrame.  Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage that run in Python workers travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
