"""Event-stream analytics on Spark: ingest, star schema, daily marts, data checks."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package travel to Python workers by value, so the workers need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
