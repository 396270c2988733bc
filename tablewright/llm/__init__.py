"""Operators of a training-data pipeline over documents, pages and embeddings."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the Python workers by value, so that executors need no
# copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
