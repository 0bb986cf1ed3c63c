"""Spark-native operators for governing text and agent activity."""

import sys

from pyspark import cloudpickle

from veilstone.session import build_session

__all__ = ["build_session"]

# Functions sent to Python workers travel whole, so that executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
