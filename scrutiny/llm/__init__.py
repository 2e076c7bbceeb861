"""Operators for training data: documents in, rows, texts and token files out.

Nothing else in the library imports this package. Its functions travel to the executors by
value, so that a cluster needs no copy of the package on its Python path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
