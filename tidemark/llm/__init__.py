"""Operators of a training-data pipeline; each module is one operator.

Functions that run inside tasks are shipped by value, so executors need no copy
of this package.
"""

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["_"]))
