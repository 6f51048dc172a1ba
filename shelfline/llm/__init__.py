"""Operators for preparing training text, vectors and web pages. Nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Row functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
