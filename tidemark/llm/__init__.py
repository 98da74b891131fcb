"""Operators of a large-scale training-data pipeline.

Python functions of this package travel to the executors by value, so that a
cluster needs no copy of the package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
