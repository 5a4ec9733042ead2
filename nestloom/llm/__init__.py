"""Operators for preparing training text at scale; nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# task functions travel with the job, so executors need no copy of this folder
cloudpickle.register_pickle_by_value(sys.modules[__name__])
