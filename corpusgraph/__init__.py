"""Corpus analytics and similarity graphs as plain Spark DataFrame functions."""

import sys

from pyspark import cloudpickle

from corpusgraph.session import build_session

__all__ = ["build_session"]

# Tasks carry the package's helper functions, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
