"""Training-data operators: near-duplicate joins, secret scans, line and span
dedup, sharding, mixing, decontamination, language ID, URL filters and
embedding near-dedup, each over whole tables as Spark jobs."""

import sys

from pyspark import cloudpickle

# Code that runs inside tasks travels with them, so executors need no copy of
# the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
