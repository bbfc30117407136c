"""Training-data operators: scoring, dedup, quality, mixing, sharding, packing, web records.

Nothing outside this package imports it.  Functions that run inside Spark
tasks are shipped by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
