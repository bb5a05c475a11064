"""Operators on text corpora: scans, deduplication, scoring, mixing, sharding, packing, archives, search."""

import sys

from pyspark import cloudpickle

# The task functions travel with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
