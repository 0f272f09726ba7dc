"""Operators for large training-data pipelines.  Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

from .queries import ORACLE_SQL, QUERIES

# Executors need no copy of this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["ORACLE_SQL", "QUERIES"]
