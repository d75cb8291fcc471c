"""Operators for training-data pipelines; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# tasks get the functions of this package with the job: executors need not have it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
