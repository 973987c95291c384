"""Training-data operators: scoring, deduplication, media, sharding, packing and fixity."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel whole, so executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
