"""Review analytics, two-stage recommendation and exact vector search as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

from palate.config import Settings

# Functions that run inside tasks travel by value, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Settings"]
