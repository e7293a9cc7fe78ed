"""Operators for training-data pipelines. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Executors need not have the package: the functions that they run travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
