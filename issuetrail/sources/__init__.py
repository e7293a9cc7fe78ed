"""Readers and writers: event archives, the agent registry, result tables and documents."""

import sys

from pyspark import cloudpickle

# Executors need not have the package: the few functions that they run travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
