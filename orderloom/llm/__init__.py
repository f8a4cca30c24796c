"""Training-data operators: filtering, deduplication, scanning, packing, search and formatting."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Tasks carry this subpackage's code with them, so executors need not have it installed.
register_pickle_by_value(sys.modules[__name__])
