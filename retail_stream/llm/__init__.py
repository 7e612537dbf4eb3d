"""Operators that prepare training data. Nothing else in the library imports this package.

Functions that run inside tasks travel with their code, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

from retail_stream import scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(scratch)
