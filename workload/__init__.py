"""Checked queries over the given tables: each a Spark job and an SQL text to compare."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
