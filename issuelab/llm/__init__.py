"""Operators for training-data text. Their functions travel to executors inside the tasks, so that workers
need no copy of this package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
