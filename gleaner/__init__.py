"""Content-quality and backfill analytics on Spark.

Functions that run in Python workers are shipped by value: executors need no
installed copy, and no module is imported there outside a session.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
