"""Operators for preparing training data: one module per operator, queries in ``queries``."""

import sys

from pyspark import cloudpickle

# functions that run inside tasks travel with the job, so executors need no installation
cloudpickle.register_pickle_by_value(sys.modules[__name__])
