"""Operators for preparing training text: formatting, fingerprints, filters, deduplication, archives and mixing."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel by value, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
