"""Operators for preparing training corpora; nothing outside this subpackage imports it."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions that run in tasks travel with the job, so that executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])
