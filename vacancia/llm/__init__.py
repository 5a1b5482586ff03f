"""Operators for preparing training data. Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# What tasks run travels to the executors with the job, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
