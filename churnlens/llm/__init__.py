"""Operators of a training-data pipeline over documents, pages, embeddings and conversations."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to Python workers by value, so executors
# don't need the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
