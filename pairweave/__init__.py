"""Parallel-corpus processing on Spark: from sentence pairs to padded training batches and translation scores."""

import sys

from pyspark import cloudpickle

# UDFs carry their helpers with them, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
