"""Operators for preparing training data; each module holds one operator, `queries` registers them."""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors with their code, so those need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
